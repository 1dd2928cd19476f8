"""Near-duplicate documents by Order MinHash and banded alignment.

A document is its lower-case words; a k-mer is five of them in a row, labelled
with how often it occurred before, so that repeats count. Each of ``SKETCHES``
hash functions picks the ``PICKED`` smallest labelled k-mers and records them in
text order: two documents agree on a sketch when they share those k-mers and
their order. Documents that agree on one sketch are aligned: the longest common
subsequence of their k-mers within the band that similarity 0.8 leaves open.
Similarity is aligned k-mers over all k-mers of both, so moved text counts as
different. A pair at exactly 0.8 agrees on about half of the sketches and is
missed about once in 90,000.

Documents of one to four words have a single k-mer, all their words; documents
without words, and null texts, are copies of one another. Rows with a null
``doc_id`` take part and come last. A class is named by its smallest ``doc_id``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from polderbook.llm.common import Scratch, text_of, words_line
from polderbook.llm.near import ODD, classes, mixed, odd_sketch, shingles, steps

WIDTH = 5
SIMILARITY = 0.8
SKETCHES = 16
PICKED = 3


def labelled(kmers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """K-mers changed by their occurrence number within their text."""
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = kmers ^ mixed(owner, 77)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    if fresh.all():
        return kmers
    since = np.arange(len(key)) - np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
    number = np.empty(len(key), np.uint64)
    number[order] = since.astype(np.uint64)
    return np.where(number > 0, mixed(kmers + number * np.uint64(0xD1B54A32D192ED03), 78), kmers)


def sketch(kmers: np.ndarray, counts: np.ndarray, seed: int) -> np.ndarray:
    """One Order MinHash value per text; every text has a k-mer."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    values = mixed(kmers, seed)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    owner = np.repeat(np.arange(len(counts)), counts)
    picked, places = [], []
    for _ in range(PICKED):
        least = np.minimum.reduceat(values, starts)
        hit = np.flatnonzero(values == least[owner])
        hit = hit[np.unique(owner[hit], return_index=True)[1]]
        picked.append(least)
        places.append(np.where(least == top, len(values), hit))
        values[hit] = top
    order = np.argsort(np.stack(places), axis=0, kind="stable")
    in_order = np.take_along_axis(np.stack(picked), order, axis=0)
    out = np.full(len(counts), seed, np.uint64)
    for row in in_order:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + row, seed)
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for others, words, sizes in steps(batches):
        kmers, counts = shingles(words, sizes, WIDTH)
        marked = labelled(kmers, counts)
        columns = [sketch(marked, counts, seed).view(np.int64) for seed in range(SKETCHES)]
        yield pa.RecordBatch.from_arrays(
            [*others.columns, *map(pa.array, (counts.astype(np.int64), *odd_sketch(marked, counts), *columns))],
            [*others.schema.names, "size", *ODD, *[f"s{i}" for i in range(SKETCHES)]])


def kmers(words: list[str], width: int = WIDTH) -> dict[int, int]:
    """Place of each labelled k-mer, by a hash of its words and its number, in text order."""
    seen: dict[int, int] = {}
    out: dict[int, int] = {}
    for i in range(max(1, len(words) - width + 1)):
        kmer = hash(tuple(words[i:i + width]))
        seen[kmer] = number = seen.get(kmer, 0) + 1
        out[kmer if number == 1 else hash((kmer, number))] = i
    return out


def alignment(a: dict[int, int], b: dict[int, int], least: float = SIMILARITY) -> float:
    """Aligned k-mers over all k-mers of both texts, or -1 if below ``least``.

    Labelled k-mers are unique within a text, so the common subsequence is the
    longest rising run of matched places; matches off the band cannot belong to
    an alignment that reaches ``least``. Texts that share too few k-mers in any
    order are not aligned.
    """
    n, m = len(a), len(b)
    if min(n, m) < least * max(n, m):
        return -1.0
    shared = len(a.keys() & b.keys())
    if shared < least * (n + m - shared):
        return -1.0
    band = (n + m) * (1 - least) / (1 + least) + 1e-9
    matched = [i for kmer, j in b.items() if abs((i := a.get(kmer, -1 << 60)) - j) <= band]
    tails: list[int] = []
    for i in matched:
        if not tails or i > tails[-1]:
            tails.append(i)
        else:
            tails[bisect_left(tails, i)] = i
    similarity = len(tails) / (n + m - len(tails))
    return similarity if similarity >= least else -1.0


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, links): classes has doc_id, class_id, class_size, kept for every row of ``docs``;
    links has doc_a, doc_b, similarity between the smallest documents of two texts."""
    rows, pairs = _classed(docs)
    return rows.drop("raw"), pairs


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``near_classes`` with ``raw``, the hash of the row's text, in the classes."""
    scratch = Scratch(docs.sparkSession, "near")
    sketches = [f"s{i}" for i in range(SKETCHES)]
    texts = docs.select("doc_id", text_of().alias("text"))
    lined = texts.select("doc_id", F.xxhash64("text").alias("raw"), words_line(F.col("text")).alias("line"))
    named = lined.select("doc_id", "raw", F.xxhash64("line").alias("id"),
                         F.transform(F.split("line", " "), lambda w: F.xxhash64(w)).alias("hashes"))
    schema = StructType([*named.schema.fields[:3], *[StructField(c, LongType()) for c in ("size", *ODD, *sketches)]])
    members = scratch.write(
        named.mapInArrow(_sketches, schema).withColumn("row", F.monotonically_increasing_id()), "members"
    )
    links, parts = classes(members, sketches, texts.select("text"), (kmers, alignment), SIMILARITY, scratch)
    part = F.coalesce("component", "id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    placed = members.join(parts, "id", "left").select("doc_id", "raw", "row", part.alias("part"))
    groups = scratch.small(placed.groupBy("part").agg(first, F.count("*").alias("n")).where("n > 1"), "groups")
    out = placed.join(groups, "part", "left").select(
        "doc_id", "raw",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("class_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("first.row"))).alias("kept"),
    )
    names = members.groupBy("id").agg(F.min("doc_id").alias("doc_id"))
    a, b = names.select(F.col("id").alias("a"), F.col("doc_id").alias("doc_a")), names.select(
        F.col("id").alias("b"), F.col("doc_id").alias("doc_b"))
    pairs = links.join(a, "a").join(b, "b").select("doc_a", "doc_b", "similarity")
    return out, pairs


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, that of the smallest document.

    Rows go by ``doc_id``, null included, and the hash of their text, so rows that
    repeat a ``doc_id`` with another text are judged on their own. The keys that go
    are removed by an anti-join, so the texts that stay are not shuffled while the
    list is small. Of rows alike in both keys the one with the smallest hash over
    its columns stays.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    found, _ = _classed(docs)
    keys = scratch.write(
        found.where("class_size > 1").groupBy(F.col("doc_id").alias("_doc_id"), F.col("raw").alias("_raw"))
        .agg(F.max("kept").alias("_kept"), F.count("*").alias("_n")), "keys"
    )
    named = [F.col(f"`{c}`") for c in docs.columns]
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = docs.select(F.struct(*named).alias("row"), F.col("doc_id").alias("own_id"),
                       F.xxhash64(text_of()).alias("own_raw"), F.xxhash64(*hashed).alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("_doc_id")) & (F.col("own_raw") == F.col("_raw"))
    stayed = rows.join(scratch.small(keys.where("not _kept").select("_doc_id", "_raw"), "gone"), same, "left_anti")
    tied = scratch.small(keys.where("_kept and _n > 1").select("_doc_id", "_raw"), "tied")
    if tied.limit(1).count():
        one = stayed.join(tied, same).groupBy("_doc_id", "_raw").agg(F.min_by("row", "own_hash").alias("row"))
        stayed = stayed.join(tied, same, "left_anti").select("row").unionByName(one.select("row"))
    return stayed.select("row.*")
