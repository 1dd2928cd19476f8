"""Mixing sources to target weights by systematic sampling.

Each document of a source expects ``target / source_size`` copies. Documents are
laid out by size and id, their expectations prefix-summed after one random
offset, and a document is taken once per whole number that its stretch crosses:
every document gets the floor or the ceiling of its expectation. Because
neighbours have about equal sizes, the taken words follow the target closely.

A null text has no words; a null source is a source of its own, after all
others. Sources without words have target 0 and nothing is taken from them.
Repeated rows are separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polderbook.llm.common import BROADCAST_BYTES, Scratch, numbered, text_of

#: Fixed values of the mix: weights in turn, the share of all words, the most copies.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(r"[^ \t-\r]+")).cast("bigint")


def _targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Source table with ``target``: weight times a level, at most ``most`` times the source's size.

    The level at which the targets add up to the budget is found by ordering the
    sources by the level at which each is full. One row per source.
    """
    in_turn = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                               (F.row_number().over(in_turn) - 1) % len(weights) + 1).cast("bigint"),
    ).withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.withColumn(
        "level",
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(onward),
    )
    full = F.col("level") >= F.col("cap") / F.col("weight")
    level = F.max(F.when(~full, F.col("level"))).over(everything)
    return levels.select(
        "source", "source_size",
        F.when(full | level.isNull(), F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"),
    )


def _offset(source: Column) -> Column:
    """A number in [0, 1) fixed by the seed and the source."""
    head = F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(source, F.lit("\u0000")))), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)


def _tie(docs: DataFrame) -> Column:
    """A hash of a row; columns that hold maps cannot be hashed and are left out."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(doc_id, source, tie, size, source_size, target, copies) of every row; ``tie`` is a hash of the row.

    Only these narrow keys are ordered, by source, size, doc_id and tie, in one range
    partitioning, so a hot source spreads over many tasks and no text is shuffled. Rows alike in
    all of them cannot be split between tasks.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    keys = docs.select("doc_id", "source", word_count().alias("size"), _tie(docs).alias("tie"))
    order = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("doc_id"), F.col("tie")]
    placed = numbered(keys, "source", order, scratch, "placed", source_size="size")
    sizes = placed.groupBy("source").agg(F.max("source_size").alias("source_size"))
    targets = scratch.small(
        _targets(sizes, weights, share, most).select(F.col("source").alias("of"), "target"), "targets")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start, place = _offset(F.col("source")), F.col("place")
    copies = F.floor(start + rate * (place + 1)) - F.floor(start + rate * place)
    return joined.select(
        "doc_id", "source", "tie", "size", "source_size", "target",
        F.least(copies, F.lit(most)).cast("bigint").alias("copies"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """Every row as often as the mix takes it, with its columns; ``copy_no`` counts from 1 and replaces a column of that name.

    Rows find their copies by doc_id and tie. Rows alike in both are taken as one row that has
    the copies of all of them. While the keys are few they are broadcast and no text moves;
    beyond that texts are shuffled once, without a sort.
    """
    scratch = Scratch(docs.sparkSession, "mixed")
    alike = scratch.write(
        mix(docs, scratch=scratch).groupBy(F.col("doc_id").alias("id"), "tie")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0"), "alike")
    scratch.drop("placed", "placed-parts", "targets")
    columns = [c for c in docs.columns if c != "copy_no"]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("doc_id").alias("of"), _tie(docs).alias("hash"))
    keys = scratch.small(alike, "keys")
    joined = row.join(keys.hint("shuffle_hash") if scratch.bytes("keys") > BROADCAST_BYTES else keys,
                      F.col("of").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("tie")))
    taken = joined.where("rows = 1").select("row", "copies")
    if alike.where("rows > 1").limit(1).count():
        taken = taken.unionByName(joined.where("rows > 1").groupBy("id", "tie").agg(
            F.first("row").alias("row"), F.first("copies").alias("copies")).select("row", "copies"))
    return taken.select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_no"))
