"""Benchmark decontamination by size-partitioned MinHash containment search.

An item counts as contained when at least 0.8 of its distinct five-word shingles
are in a document, however long that document is. Items are partitioned by their
number of shingles n; the signature of an item is its k smallest shingle hashes
with k = n - ceil(0.8 n) + 1. A document that lacks all k cannot reach 0.8, so
the search misses nothing, and small items need only a few hashes. Every
document shingle probes the signatures; hits are verified by exact containment
of the shingle texts.

Words are lower case, split at anything but letters, marks and digits. Items
with fewer than five words have no shingle and match nothing. Null texts have no
words. Documents with the same text share a result; a null ``doc_id`` is kept.
Of items with the same id all texts count as separate items. Only functions of
Spark SQL are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, text_of, words_line

WIDTH = 5
CONTAINED = 0.8
#: Looks ahead for five words, then steps one word on.
RUN = "(?=(" + " ".join(["[^ ]++"] * WIDTH) + "))[^ ]++"


def _spelled(frame: DataFrame, *keep: str) -> DataFrame:
    """One row per run of five words of ``line``: the columns ``keep`` and ``shingle``."""
    return frame.select(*keep, F.explode(F.regexp_extract_all("line", F.lit(RUN), F.lit(1))).alias("shingle"))


def text_key(column: str = "text") -> Column:
    return F.md5(text_of(column))


def signatures(items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """(shingle, item, part): the signature hashes of each item; part is the size class, a power of two."""
    hashed = _spelled(items, "item").select("item", F.xxhash64("shingle").alias("shingle")).groupBy("item").agg(
        F.sort_array(F.collect_set("shingle")).alias("all"))
    n = F.size("all")
    length = n - F.ceil(n * F.lit(contained)) + 1
    return hashed.select(
        "item", F.floor(F.log2(n)).alias("part"), F.explode(F.slice("all", F.lit(1), length.cast("int"))).alias("shingle")
    )


def containment(docs: DataFrame, benchmark: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """(text_key, item_id, n_shared, n_shingles) of every contained item and distinct text."""
    scratch = Scratch(docs.sparkSession, "containment")
    items = scratch.write(
        benchmark.select("item_id", words_line(text_of()).alias("line")).distinct()
        .withColumn("item", F.xxhash64("item_id", "line")), "items"
    )
    signed = scratch.small(signatures(items, contained), "signatures")
    named = docs.select(text_key().alias("text_key"), text_of().alias("text"))
    hits = scratch.write(
        _spelled(named.select("text_key", words_line(F.col("text")).alias("line")), "text_key").select("text_key", F.xxhash64("shingle").alias("shingle"))
        .join(signed, "shingle").select("text_key", "item").distinct(), "hits"
    )
    texts = named.join(
        scratch.small(hits.select("text_key").distinct(), "keys"), "text_key", "left_semi"
    ).groupBy("text_key").agg(F.max("text").alias("text")).select("text_key", words_line(F.col("text")).alias("line"))
    spelled = _spelled(items, "item", "item_id").distinct()
    # an item's name covers its item_id, which may be null
    sizes = spelled.groupBy("item").agg(F.count("*").alias("n_shingles"))
    known = scratch.small(spelled.join(sizes, "item"), "shingles")
    shared = (
        _spelled(texts, "text_key").join(known, "shingle").join(hits, ["text_key", "item"], "left_semi")
        .groupBy("text_key", "item", "item_id", "n_shingles").agg(F.count_distinct("shingle").alias("n_shared"))
    )
    found = scratch.write(
        shared.where(F.col("n_shared") >= F.col("n_shingles") * F.lit(contained))
        .groupBy("text_key", "item_id", "n_shingles").agg(F.max("n_shared").alias("n_shared")), "found"
    )
    scratch.drop("hits", "keys", "signatures", "shingles", "items")
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles): one row per document row and item it contains."""
    found = containment(docs, benchmark)
    keyed = docs.select("doc_id", text_key().alias("text_key"))
    small = Scratch(docs.sparkSession, "contaminated").small(found, "found")
    return keyed.join(small, "text_key").select("doc_id", "item_id", "n_shared", "n_shingles")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns."""
    found = containment(docs, benchmark).select(F.col("text_key").alias("gone")).distinct()
    small = Scratch(docs.sparkSession, "decontaminate").small(found, "gone")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key().alias("key"))
    return row.join(small, F.col("key") == F.col("gone"), "left_anti").select("row.*")
