"""Phrase collocations by dynamic itemset counting.

The documents are dealt into ``SHARDS`` shards that are scanned in turn, again and again.
Each scan counts all lengths that are active: single words from the start, a longer phrase
from the scan after both its parts that lack one end word reached the threshold. A phrase
is counted for one full cycle of shards, whichever shard it began with, so its count is
exact; no phrase that reaches the threshold can be missed, since its parts occur at least
as often. Scanning ends when nothing is active.

One scan is one shuffle: numpy counts the shard's active phrases per batch, and these
partial counts are summed, after the shuffle, together with the counts so far. Two bit filters of fixed size
tell the scan which parts have reached the threshold, and which did so within the last
cycle. Their false alarms cost time but no count, see ``counted``.

Words are named by 64-bit hashes of language and word; words of ``LONG`` bytes or more by a digest,
since a polynomial modulo 2^64 gives some long words of regular build one name. The names are checked against the
spelt words of all phrases returned; should two words share one, all is counted again with
another seed. Null texts have no words, a null language is ``und``; an empty table gives
an empty result. Repeated rows count each time. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, text_of
from polderbook.llm.near import mixed

#: Fixed values of the task.
LEAST = 10
TOP = 2000
ABSORBED = 50
SCALE = 1_000_000
#: Shards of a cycle.
SHARDS = 3
#: Bits of a filter, in blocks of 4 KiB.
FILTER_BITS = 1 << 25
BLOCK_BITS = 32768
#: Bytes from which a word is named by a digest.
LONG = 256
#: Bytes of text that one numpy step works on, unless a piece is longer.
STEP_BYTES = 1 << 20
#: Namings of words that are tried; one in which two words share a name is nearly never met.
SEEDS = 3
#: Phrases that are held before their counts leave the task.
HELD = 1_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
IN_WORD = ~BREAKS
IN_WORD[list(b" \t")] = False
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)

STATE = "w0 bigint, w1 bigint, w2 bigint, n bigint"
KEY = ["w0", "w1", "w2"]


# ---- words of a batch -----------------------------------------------------------------

class Words:
    """Cuts texts into words and names them."""

    def __init__(self, seed: int):
        self.seed = seed
        self.table = mixed(np.arange(1, 257, dtype=np.uint64), 100 + seed)
        self.powers = self.inverse = np.ones(1, np.uint64)
        self.langs: dict[str, int] = {}

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            for name, factor in (("powers", FACTOR), ("inverse", INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def lang(self, lang: str) -> int:
        if lang not in self.langs:
            self.langs[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        return self.langs[lang]

    def steps(self, langs: list[str], texts: pa.Array) -> Iterator[tuple]:
        """(names, pieces, texts of the words as places in bytes, document of each word) of some bytes at a time.

        Words with the same piece number stand in one piece of one document.
        """
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        if not len(texts) or offsets[-1] == offsets[0]:
            return
        raw = np.frombuffer(texts.buffers()[2], np.uint8)
        named = mixed(np.array([self.lang(x) for x in langs], np.uint64), 200 + self.seed)
        at, end = int(offsets[0]), int(offsets[-1])
        while at < end:
            stop = min(end, at + STEP_BYTES)
            if stop < end:
                stop = self._cut(raw, offsets, at, stop, end)
            yield self._words(LOWER[raw[at:stop]], at, offsets, named)
            at = stop

    @staticmethod
    def _cut(raw: np.ndarray, offsets: np.ndarray, at: int, stop: int, end: int) -> int:
        """A place near ``stop`` where a document or a piece ends; at or after it if none is before."""
        document = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
        if document > at:
            return document
        before = np.flatnonzero(BREAKS[raw[at:stop]])
        if len(before):
            return at + int(before[-1]) + 1
        here = int(offsets[np.searchsorted(offsets, stop, "right")])
        while stop < here:
            after = np.flatnonzero(BREAKS[raw[stop:min(here, stop + STEP_BYTES)]])
            if len(after):
                return stop + int(after[0]) + 1
            stop = min(here, stop + STEP_BYTES)
        return min(stop, end)

    def _words(self, text: np.ndarray, at: int, offsets: np.ndarray, named: np.ndarray) -> tuple:
        inside = IN_WORD[text]
        first, last = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, at + len(text), "left")
        begins = offsets[first + 1:last] - at
        begins = begins[begins < len(text)]
        start, stop = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        start[begins] = inside[begins]
        stop[:-1] &= ~inside[1:]
        stop[begins[begins > 0] - 1] = inside[begins[begins > 0] - 1]
        starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
        self._grow(len(text) + 1)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.table[text] * self.powers[:len(text)], out=sums[1:])
        names = (sums[stops] - sums[starts]) * self.inverse[starts] + (stops - starts).astype(np.uint64)
        for i in np.flatnonzero(stops - starts >= LONG).tolist():
            digest = hashlib.blake2b(text[starts[i]:stops[i]].tobytes(), digest_size=8, key=b"%d" % self.seed)
            names[i] = int.from_bytes(digest.digest(), "little")
        before = np.searchsorted(starts, offsets[first + 1:last] - at)
        document = np.repeat(np.arange(first, last), np.diff(before, prepend=0, append=len(starts)))
        names = mixed(names ^ named[document], 300 + self.seed)
        names[names == 0] = 1
        pieces = np.cumsum(BREAKS[text])[starts] + document
        return names, pieces, text, starts, stops, document


def _rotated(names: np.ndarray) -> np.ndarray:
    return (names << np.uint64(17)) | (names >> np.uint64(47))


def _hit(bits: np.ndarray, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Whether the filter holds the names, single or in pairs."""
    mask = np.uint64(8 * len(bits) - 1)
    slots = ((first if second is None else first ^ _rotated(second)) & mask).astype(np.int64)
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & np.uint8(1) == 1


def _slot(first: Column, second: Column) -> Column:
    """The place of a name, or a pair, in a filter; a missing second name is 0."""
    turned = F.shiftleft(second, 17).bitwiseOR(F.shiftrightunsigned(second, 47))
    return first.bitwiseXOR(turned).bitwiseAND(F.lit(FILTER_BITS - 1))


class Counts:
    """Counts of phrases of one length; ``take`` empties it."""

    def __init__(self, length: int):
        self.length = length
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.parts.append(columns)
            self.held += len(columns[0])

    def take(self) -> pa.RecordBatch:
        """Rows of ``STATE``; for single words the second column added names their language."""
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        words = columns[:self.length]
        key = words[0].copy()
        for w in words[1:]:
            key = _rotated(key) ^ w
        # values sort faster than places: the key's high bits, then the place; keys alike in those bits may split a count
        low = np.uint64((1 << len(key).bit_length()) - 1)
        order = (np.sort((key & ~low) | np.arange(len(key), dtype=np.uint64)) & low).astype(np.int64)
        words = [w[order] for w in words]
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.logical_or.reduce([w[1:] != w[:-1] for w in words])
        at = np.flatnonzero(fresh)
        n = np.diff(np.append(at, len(order)))
        out = [np.zeros(len(at), np.int64) for _ in range(3)]
        for i, w in enumerate(words):
            out[i] = w[at].view(np.int64)
        if self.length == 1:
            out[2] = columns[1][order][at].view(np.int64)
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays(list(map(pa.array, (*out, n))), ["w0", "w1", "w2", "n"])


def _scan(shard: DataFrame, seed: int, with_words: bool, filters) -> DataFrame:
    """Partial counts of the active phrases of a shard (lang, text)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(seed)
        counts = [Counts(k) for k in (1, 2, 3)]
        ever, lately = (np.frombuffer(f, np.uint8) for f in filters.value) if filters else (None, None)
        for batch in batches:
            tongues = batch.column(0).to_pylist()
            codes = np.array([words.lang(x) for x in tongues], np.uint64)
            for names, pieces, _, _, _, document in words.steps(tongues, batch.column(1)):
                if with_words:
                    counts[0].add(names, codes[document])
                if ever is not None and len(names) > 1:
                    reached, late = _hit(ever, names), _hit(lately, names)
                    joined = pieces[1:] == pieces[:-1]
                    pick = joined & reached[1:] & reached[:-1] & (late[1:] | late[:-1])
                    counts[1].add(names[:-1][pick], names[1:][pick])
                    pairs = np.flatnonzero(joined & reached[1:] & reached[:-1])
                    double = names[pairs], names[pairs + 1]
                    known, fresh = np.zeros(len(names), bool), np.zeros(len(names), bool)
                    # a word's late part counts as well: a pair's place may have been taken by a false alarm before
                    # its words were frequent, and a triple must be counted for a full cycle from its last part on
                    known[pairs], fresh[pairs] = _hit(ever, *double), _hit(lately, *double) | late[pairs] | late[pairs + 1]
                    pick = np.flatnonzero(known[:-2] & known[1:-1] & (fresh[:-2] | fresh[1:-1]))
                    counts[2].add(names[pick], names[pick + 1], names[pick + 2])
                for c in counts:
                    if c.held >= HELD:
                        yield c.take()
        for c in counts:
            if c.held:
                yield c.take()

    return shard.select("lang", "text").mapInArrow(counted, STATE)


def _spelt(shard: DataFrame, seed: int, wanted) -> DataFrame:
    """(w0, lang, word): the words whose names the filter ``wanted`` may hold, once per step."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(seed)
        bits = np.frombuffer(wanted.value, np.uint8)
        sent: set[int] = set()
        for batch in batches:
            tongues = batch.column(0).to_pylist()
            for names, _, text, starts, stops, document in words.steps(tongues, batch.column(1)):
                # every spelling of a name counts, so a word is left out only where name, length and ends agree
                some = np.flatnonzero(_hit(bits, names))
                shape = mixed(names[some] ^ (stops - starts)[some].astype(np.uint64), 7) ^ (
                    text[starts[some]].astype(np.uint64) << np.uint64(8)) ^ text[stops[some] - 1].astype(np.uint64)
                _, one = np.unique(shape, return_index=True)
                new = [(int(i), s) for i, s in zip(some[one], shape[one].tolist(), strict=True) if s not in sent]
                if len(sent) > HELD:
                    sent.clear()
                sent.update(s for _, s in new)
                spelling = text.tobytes()
                at = [i for i, _ in new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[at].view(np.int64), pa.int64()),
                     pa.array([tongues[document[i]] for i in at], pa.string()),
                     pa.array([spelling[starts[i]:stops[i]].decode() for i in at], pa.string())], ["w0", "lang", "word"])

    return shard.select("lang", "text").mapInArrow(found, "w0 bigint, lang string, word string")


def _bitmap(rows: DataFrame, slot: Column) -> int:
    """The filter of ``rows`` as a number of ``FILTER_BITS`` bits; its size does not depend on them."""
    bits = bytearray(FILTER_BITS // 8)
    blocks = rows.select(slot.alias("slot")).groupBy(F.shiftright("slot", 15).alias("block")).agg(
        F.expr(f"bitmap_construct_agg(slot & {BLOCK_BITS - 1})").alias("bits"))
    for block, part in blocks.collect():
        bits[block * BLOCK_BITS // 8:(block + 1) * BLOCK_BITS // 8] = part
    return int.from_bytes(bits, "little")


# ---- scans ------------------------------------------------------------------------------

def _dealt(docs: DataFrame, scratch: Scratch) -> DataFrame:
    rows = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SHARDS)).cast("int").alias("shard"))
    folder = f"{scratch.folder}/shards"
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema("lang string, text string, shard int").parquet(folder)


def counted(shards: DataFrame, scratch: Scratch, seed: int = 0, least: int = LEAST) -> DataFrame:
    """(k, w0, w1, w2, n): every phrase of up to three words with ``least`` or more occurrences, and every
    word; for single words ``w2`` names the language.

    A phrase is scanned for in the ``SHARDS`` turns after the last of its parts took its place in the
    filter. A false alarm lets that place be taken earlier, so the cycle starts early, but it is still one full cycle.
    """
    spark = shards.sparkSession
    state, filters, done, ever, recent = None, None, [], 0, []
    turn = 0
    while True:
        found = _scan(shards.where(F.col("shard") == turn % SHARDS), seed, turn < SHARDS, filters).withColumn(
            "since", F.lit(turn))
        if state is not None:
            found = found.unionByName(state.where(F.col("since") > turn - SHARDS))
        # a task's rows hardly share a key, since its counts are summed before and the state's keys differ: summed after the shuffle alone
        now = scratch.write(
            found.repartition(*KEY).groupBy(*KEY).agg(F.sum("n").alias("n"), F.min("since").alias("since")), f"state-{turn}")
        kept = scratch.write(now.where((F.col("n") >= least) | (F.col("w1") == 0)), f"kept-{turn}")
        parts = kept.where((F.col("n") >= least) & ((F.col("w1") == 0) | (F.col("w2") == 0)))
        bits = _bitmap(parts, _slot(F.col("w0"), F.col("w1")))
        recent = [*recent, bits & ~ever][-SHARDS:]
        ever |= bits
        lately = reduce(int.__or__, recent)
        # without late parts nothing will be counted any more, and all counts are complete
        last = turn >= SHARDS - 1 and not lately
        kind = F.when(F.col("w1") == 0, 1).when(F.col("w2") == 0, 2).otherwise(3)
        ended = F.col("since") > turn - SHARDS if last else F.col("since") == turn - SHARDS + 1
        done.append(scratch.write(
            kept.where(ended).select(kind.alias("k"), *KEY, "n"), f"done-{turn}"))
        scratch.drop(f"kept-{turn}")
        if state is not None:
            scratch.drop(f"state-{turn - 1}")
        state = now
        turn += 1
        if last:
            break
        if filters is not None:
            filters.unpersist()
        filters = spark.sparkContext.broadcast(tuple(x.to_bytes(FILTER_BITS // 8, "little") for x in (ever, lately)))
    scratch.drop(f"state-{turn - 1}")
    return reduce(DataFrame.unionByName, done).groupBy("k", *KEY).agg(F.max("n").alias("n"))


# ---- scores -----------------------------------------------------------------------------

def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(18,0)")


def score(a: str, left: str, right: str, scale: int = SCALE) -> Column:
    """floor(scale a a / (l r)), exact for counts below 10 ** 15."""
    return F.expr(f"cast(({scale} * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)))"
                  f" div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0))) as bigint)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, absorbed: int = ABSORBED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two and three words.

    a, l and r count the phrase and the parts of its weakest cut, n the words of the language. A
    pair that ``absorbed`` or more per cent of the time stands in one longer candidate is left out.
    """
    for seed in range(SEEDS):
        scratch = Scratch(docs.sparkSession, f"phrases-{seed}")
        found, shared = _ranked(_dealt(docs, scratch), scratch, seed, least, top, absorbed)
        if not shared:
            return found
    raise RuntimeError("words share names under every seed")


def _ranked(
    shards: DataFrame, scratch: Scratch, seed: int, least: int, top: int, absorbed: int
) -> tuple[DataFrame, bool]:
    """The result, and whether two words shared a name in it."""
    counts = counted(shards, scratch, seed, least)
    counts = scratch.write(counts, "counts")
    totals = scratch.small(counts.where("k = 1").groupBy(F.col("w2").alias("tongue")).agg(F.sum("n").alias("n")), "totals")
    words = scratch.write(
        counts.where((F.col("k") == 1) & (F.col("n") >= least)).select("w0", F.col("w2").alias("tongue"), "n"), "words")
    pairs = scratch.write(counts.where(F.col("k") == 2).select("w0", "w1", "n"), "pairs")
    triples = scratch.write(counts.where(F.col("k") == 3).select("w0", "w1", "w2", F.col("n").alias("a")), "triples")

    def word(at: str, n: str) -> DataFrame:
        return words.select(F.col("w0").alias(at), F.col("n").alias(n))

    def pair(first: str, second: str, n: str) -> DataFrame:
        return pairs.select(F.col("w0").alias(first), F.col("w1").alias(second), F.col("n").alias(n))

    longer = triples.select("a", F.explode(F.array(F.struct("w0", "w1"), F.struct(F.col("w1").alias("w0"), F.col("w2").alias("w1")))).alias("p")).groupBy(
        F.col("p.w0").alias("w0"), F.col("p.w1").alias("w1")).agg(F.max("a").alias("most"))
    two = (
        pairs.withColumnRenamed("n", "a").join(longer, ["w0", "w1"], "left")
        .where(F.col("most").isNull() | (_wide("most") * 100 < _wide("a") * absorbed))
        .join(words.select("w0", "tongue", F.col("n").alias("l")), "w0").join(word("w1", "r"), "w1")
        .select("tongue", "w0", "w1", F.lit(0).cast("bigint").alias("w2"), "a",
                F.struct(score("a", "l", "r").alias("score"), F.lit(1).alias("cut"), "l", "r").alias("best"))
    )
    three = (
        triples.join(words.select("w0", "tongue", F.col("n").alias("l1")), "w0").join(pair("w1", "w2", "r1"), ["w1", "w2"])
        .join(pair("w0", "w1", "l2"), ["w0", "w1"]).join(word("w2", "r2"), "w2")
        .select("tongue", "w0", "w1", "w2", "a", F.least(
            F.struct(score("a", "l1", "r1").alias("score"), F.lit(1).alias("cut"), F.col("l1").alias("l"), F.col("r1").alias("r")),
            F.struct(score("a", "l2", "r2").alias("score"), F.lit(2).alias("cut"), F.col("l2").alias("l"), F.col("r2").alias("r")),
        ).alias("best"))
    )
    scored = two.unionByName(three).select("tongue", "w0", "w1", "w2", "a", "best.score", "best.l", "best.r")
    best = Window.partitionBy("tongue").orderBy(F.desc("score"), F.desc("a"))
    # phrases tied at the end all stay until they are spelt
    ahead = scratch.write(scored.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place"), "ahead")
    names = scratch.small(
        ahead.select(F.explode(F.array("w0", "w1", "w2")).alias("w0")).where("w0 <> 0").distinct(), "names")
    wanted = shards.sparkSession.sparkContext.broadcast(
        _bitmap(names, _slot(F.col("w0"), F.lit(0).cast("bigint"))).to_bytes(FILTER_BITS // 8, "little"))
    spelling = F.struct("lang", "word")
    spelt = scratch.write(
        _spelt(shards, seed, wanted).join(names, "w0").groupBy("w0")
        .agg(F.min(spelling).alias("one"), F.max(spelling).alias("other")), "spelt")
    shared = bool(spelt.where("one <> other").limit(1).count())
    named = ahead
    for i in range(3):
        spelling = spelt.select(
            F.col("w0").alias(f"w{i}"), F.col("one.word").alias(f"word{i}"), *([] if i else [F.col("one.lang").alias("lang")]))
        named = named.join(spelling, f"w{i}", "left" if i == 2 else "inner")
    phrased = named.withColumn("phrase", F.concat_ws(" ", "word0", "word1", "word2"))
    rank = F.row_number().over(Window.partitionBy("tongue").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = phrased.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top).join(totals, "tongue").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return out, shared
