"""Exact deduplication behind a two-pass Bloom filter.

Pass one counts, for every text hash, two positions of a blocked Bloom filter
and keeps the positions hit at least twice. Pass two tests each row: a text that
occurs twice has both its positions in that filter, so a row that misses one is
unique and passes straight through. Only the rest, true copies and a few false
alarms, shuffle and are grouped by their SHA-256.

Texts are equal when identical after each run of ASCII white space becomes one
space; a null text is an empty one. Rows with a null ``doc_id`` take part and
come after all others; among rows that agree in text and ``doc_id`` the first
stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, text_of

#: Positions in one block of the filter, and filter positions per row.
BLOCK_BITS = 32768
BITS_PER_ROW = 16
#: A filter up to this size goes to every task; a larger one is joined by block.
FILTER_BYTES = 64 << 20


def normal_text(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), r"[ \t-\r]+", " ")


def digest(column: str = "text") -> Column:
    return F.unhex(F.sha2(normal_text(column), 256))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _positions(key: Column) -> tuple[Column, Column]:
    second = F.xxhash64(F.lit("position"), key)
    return (
        F.pmod(second, F.lit(BLOCK_BITS)).cast("int"),
        F.pmod(F.shiftright(second, 24), F.lit(BLOCK_BITS)).cast("int"),
    )


def repeat_filter(keys: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Bitmap per block of the positions that two or more rows hit; ``keys`` has the column ``digest``.

    Hits are summed before the shuffle, so a text with a third of all rows costs
    one row per task. A row whose two positions coincide counts once.
    """
    blocks = max(1, -(-rows * BITS_PER_ROW // BLOCK_BITS))
    one, two = _positions(F.col("digest"))
    hits = keys.select(
        _block(F.col("digest"), blocks).alias("block"),
        F.explode(F.array_distinct(F.array(one, two))).alias("position"),
    )
    again = hits.groupBy("block", "position").agg(F.count("*").alias("n")).where("n >= 2")
    bits = again.groupBy("block").agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(position + 1))").alias("bits")
    )
    return bits, blocks


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.call_function("bit_get", byte.cast("bigint"), F.pmod(position, F.lit(8))) == 1


def mark_repeats(keys: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """``keys`` with ``maybe_repeated``; false only for a text that occurs once."""
    one, two = _positions(F.col("digest"))
    joined = keys.withColumn("_block", _block(F.col("digest"), blocks)).join(
        bits.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")), "_block", "left"
    )
    flag = F.coalesce(_is_set(F.col("_bits"), one) & _is_set(F.col("_bits"), two), F.lit(False))
    return joined.withColumn("maybe_repeated", flag).drop("_block", "_bits")


def _filter_table(scratch: Scratch, keys: DataFrame, rows: int) -> tuple[DataFrame, int]:
    bits, blocks = repeat_filter(keys, rows)
    return scratch.small(bits, "filter", FILTER_BYTES), blocks


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "exact-groups")
    keys = scratch.write(
        docs.select("doc_id", digest().alias("digest")).withColumn("_row", F.monotonically_increasing_id()),
        "keys",
    )
    bits, blocks = _filter_table(scratch, keys, keys.count())
    marked = mark_repeats(keys, bits, blocks)
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    alone = marked.where(~F.col("maybe_repeated")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), sha,
    )
    suspects = marked.where("maybe_repeated")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first")
    groups = scratch.small(
        suspects.groupBy("digest").agg(first, F.count("*").alias("n")).where("n >= 2"), "groups"
    )
    grouped = suspects.join(groups, "digest", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("n").isNull() | (F.col("_row") == F.col("first._row"))).alias("kept"), sha,
    )
    return alone.unionByName(grouped)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    Unique rows are not shuffled. Possible copies are reduced to one row per
    text before and after the shuffle, so no task holds a group of copies.
    Of rows alike in text and ``doc_id`` the one with the smallest hash of all
    columns stays.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    keys = scratch.write(docs.select(digest().alias("digest")), "keys")
    bits, blocks = _filter_table(scratch, keys, keys.count())
    scratch.drop("keys")
    columns = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), digest().alias("digest"))
    marked = mark_repeats(row, bits, blocks)
    alone = marked.where(~F.col("maybe_repeated")).select("row.*")
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.xxhash64("row"))
    kept = marked.where("maybe_repeated").groupBy("digest").agg(F.min_by("row", order).alias("row")).select("row.*")
    return alone.unionByName(kept)
