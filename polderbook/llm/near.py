"""Links and classes of near-duplicate texts from bucketed sketches.

A bucket holds the texts that share one sketch value. Its pairs are found in two
steps. First, in a few rounds, every text is compared with one leading text of each
of its buckets, another in each round, which is one pair per text, bucket and
round and joins nearly all of a large group. Then, in
buckets whose texts do not all belong to one class yet, the pairs across classes
are compared. Pairs within a class cannot change it, so the classes are those of
all pairs of all buckets, without writing out the pairs of a group.

Both joins carry an odd sketch of each text: a row of bits in which every
shingle flips one. Two texts differ in at least as many shingles as bits, so a
pair whose bits differ too often is below the threshold for certain and leaves
the join no row. The test loses no pair; for very long texts it rejects little.
A pair across classes is written in the smallest of its common buckets only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, words_line
from polderbook.llm.components import components

#: What a comparison needs of a text, made once per task and text, and the comparison itself.
Prepare = Callable[[list[str]], object]
Compare = Callable[[object, object], float]
#: Words of prepared texts that a task remembers.
REMEMBER_WORDS = 1_000_000
#: Rounds against one leading text per bucket, before the pairs across classes.
ROUNDS = 2
#: Bits of an odd sketch, and the columns that hold them, 64 each.
ODD_BITS = 1024
ODD = [f"o{i}" for i in range(ODD_BITS // 64)]
#: Words that one numpy step works on, so that its arrays stay small.
STEP_WORDS = 400_000


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(other columns, word hashes end to end, words per text) of some texts at a time; the last column has the hashes."""
    for batch in batches:
        last = batch.num_columns - 1
        lists = batch.column(last)
        others = batch.select(list(range(last)))
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
        at, start = 0, 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, start + STEP_WORDS, "right")))
            stop = int(ends[upto - 1])
            sizes = np.diff(ends[at:upto], prepend=start)
            yield others.slice(at, upto - at), flat[start:stop], sizes
            at, start = upto, stop


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer; each seed gives another order of the values."""
    x = values ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(29)
    return x


def shingles(words: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words, text after text, and how many each text has.

    A text of fewer words, but at least one, has one shingle: all its words.
    """
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1)).astype(np.int64)
    total = int(counts.sum())
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    place = starts[owner] + np.arange(total) - first[owner]
    out = np.full(total, 0x2545F4914F6CDD1D, np.uint64)
    left = sizes[owner] if total else np.zeros(0, np.int64)
    for i in range(width):
        has = left > i
        word = words[np.where(has, place + i, 0)] if total else words[:0]
        out = np.where(has, mixed(out * np.uint64(0x9E3779B97F4A7C15) + word, i), out)
    return out, counts


def odd_sketch(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The columns ``ODD`` of texts with ``counts`` distinct ``values`` each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    bit = (mixed(values, 79) % np.uint64(ODD_BITS)).astype(np.int64)
    flips = np.bincount(owner * ODD_BITS + bit, minlength=len(counts) * ODD_BITS) & 1
    packed = np.packbits(flips.astype(np.uint8).reshape(len(counts), ODD_BITS), axis=1)
    return [np.ascontiguousarray(packed[:, at:at + 8]).view(np.int64).ravel() for at in range(0, ODD_BITS // 8, 8)]


def verified(
    pairs: DataFrame, members: DataFrame, raw: DataFrame, verify: tuple[Prepare, Compare], scratch: Scratch, name: str
) -> DataFrame:
    """Table (a, b, similarity) of the pairs that the comparison accepts with 0 or more.

    ``members`` has (id, raw): the name of a normalised text and a hash of a raw
    text behind it; ``raw`` has (text), every raw text. Only texts that some pair
    needs are normalised and shuffled.
    """
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = scratch.small(
        members.join(ids, "id", "left_semi").groupBy("id").agg(F.min("raw").alias("raw")).select("raw").distinct(),
        f"{name}-wanted",
    )
    texts = raw.select(F.xxhash64("text").alias("raw"), "text").join(wanted, "raw", "left_semi")
    lines = scratch.write(
        texts.groupBy("raw").agg(F.max("text").alias("text")).select(words_line(F.col("text")).alias("line"))
        .select(F.xxhash64("line").alias("id"), "line").groupBy("id").agg(F.max("line").alias("line")),
        f"{name}-lines",
    )
    both = (
        pairs.join(lines.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
        .join(lines.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
        .select("a", "b", "line_a", "line_b")
    )

    prepare, similarity = verify

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[int, object] = {}
        held = 0
        for batch in batches:
            a, b, left, right = batch.columns
            scores = []
            for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist(), strict=True)):
                for key, line in ((x, left), (y, right)):
                    if key not in ready:
                        words = line[i].as_py().split(" ")
                        if held > REMEMBER_WORDS:
                            ready, held = {k: ready[k] for k in (x, y) if k in ready}, 0
                        ready[key] = prepare(words)
                        held += len(words)
                scores.append(similarity(ready[x], ready[y]))
            found = pa.RecordBatch.from_arrays([a, b, pa.array(scores, pa.float64())], ["a", "b", "similarity"])
            yield found.filter(pa.array([s >= 0 for s in scores], pa.bool_()))

    links = scratch.write(both.mapInArrow(compare, "a bigint, b bigint, similarity double"), f"{name}-links")
    scratch.drop(f"{name}-wanted", f"{name}-lines")
    return links


def _alike(a: str, b: str, least: float) -> Column:
    """False where shingle counts or odd sketches prove two texts to be below ``least``.

    ``a`` and ``b`` are prefixes of the columns. At similarity s, texts of n and m
    shingles differ in (n + m) (1 - s) / (1 + s) of them.
    """
    n, m = F.col(f"{a}size"), F.col(f"{b}size")
    apart = sum((F.bit_count(F.col(f"{a}{o}").bitwiseXOR(F.col(f"{b}{o}"))) for o in ODD), F.lit(0))
    return (F.least(n, m) >= F.greatest(n, m) * F.lit(least)) & (
        apart <= (n + m) * F.lit((1 - least) / (1 + least) + 1e-9))


def _named(live: DataFrame, parts: DataFrame | None) -> DataFrame:
    """``live`` with ``part``, the class that each text has so far."""
    if parts is None:
        return live.withColumn("part", F.col("id"))
    return live.join(parts, "id", "left").select(*live.columns, F.coalesce("component", "id").alias("part"))


def classes(
    members: DataFrame, bands: list[str], raw: DataFrame, verify: tuple[Prepare, Compare], least: float,
    scratch: Scratch,
) -> tuple[DataFrame, DataFrame]:
    """(links, components): links (a, b, similarity), components (id, component).

    ``members`` has (id, raw, size), the columns ``ODD`` and a column per band; size is the
    number of distinct shingles.
    """
    rows = members.select("id", "size", *ODD, F.array(*bands).alias("all")).withColumn("bucket", F.explode("all"))
    firsts = scratch.small(
        rows.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
        .select("bucket"), "firsts",
    )
    live = scratch.write(rows.join(firsts, "bucket", "left_semi").distinct(), "live")
    links = stars = parts = None
    for turn in range(ROUNDS):
        # the smallest text leads first, then another one in each bucket; texts already in its class are not compared
        order = F.struct((F.xxhash64("id", "bucket", F.lit(turn)) if turn else F.col("id")).alias("order"),
                         "id", "size", "part", *ODD)
        named = _named(live, parts)
        leaders = scratch.small(named.groupBy("bucket").agg(F.min(order).alias("lead")).select(
            "bucket", *[F.col(f"lead.{c}").alias(f"first_{c}") for c in ("id", "size", "part", *ODD)]), f"leaders-{turn}")
        pairs = named.join(leaders, "bucket").where(
            (F.col("part") != F.col("first_part")) & _alike("", "first_", least)
        ).select(F.least("id", "first_id").alias("a"), F.greatest("id", "first_id").alias("b")).distinct()
        new = scratch.write(pairs if stars is None else pairs.join(stars, ["a", "b"], "left_anti"), f"stars-{turn}")
        found = verified(new, members, raw, verify, scratch, f"links-{turn}")
        links = found if links is None else links.unionByName(found)
        stars = new if stars is None else stars.unionByName(new)
        parts = components(links, scratch, f"part-{turn}")
    named = _named(live, parts)
    mixed_up = named.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    open_rows = scratch.write(named.join(mixed_up.select("bucket"), "bucket", "left_semi"), "open")
    left, right = (
        open_rows.select("bucket", *[F.col(c).alias(f"{side}_{c}") for c in ("id", "part", "size", "all", *ODD)])
        for side in ("left", "right")
    )
    across = left.join(right, "bucket").where(
        (F.col("left_id") < F.col("right_id")) & (F.col("left_part") != F.col("right_part"))
        & _alike("left_", "right_", least)
        & (F.array_min(F.array_intersect("left_all", "right_all")) == F.col("bucket"))
    ).select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    rest = scratch.write(across.join(stars, ["a", "b"], "left_anti"), "rest")
    final = parts
    if rest.limit(1).count():
        links = links.unionByName(verified(rest, members, raw, verify, scratch, "two"))
        final = components(links, scratch, "class")
    scratch.drop("firsts", "live", "open", "rest", *[f"{kind}-{t}" for t in range(ROUNDS) for kind in ("leaders", "stars")])
    return links, final
