"""Token ids in binary shard files: patched frame-of-reference blocks.

A shard is one file, written by Spark's text writer as one record, so its commit protocol
covers lost executors and any file system; the file ends in the writer's line feed. Rows are range
partitioned by ``doc_id`` and sorted; a task cuts its documents into shards of about
``SHARD_IDS`` ids, whole documents only. Layout, little endian:

- header: magic ``PFR1``, task, shard in task, documents, ids, blocks, block length;
- documents: the doc_ids (int64), a flag per null doc_id (uint8), the ids of each (uint64);
- blocks: minimum (uint32), packed width (uint8), outliers (uint16), start in the payload
  (uint64) of each, the index that lets a reader take single blocks;
- payload: each block's ids less its minimum, packed at the width that holds ``PERCENTILE``
  per cent of them, then its outliers: places (uint16) and the bits that did not fit (uint32).

Every text, null read as empty, is followed by the id ``END``. Rows with a null ``doc_id``
come last. Rows that repeat a ``doc_id`` are ordered by the hash of their text; rows alike in both are interchangeable.
An empty table writes no shard and reads back as no row.

The tokenizer is a parameter. Texts are cut only between a non-space and a single space or line
feed in front of a non-space, where the byte-level pre-tokenizer always ends a piece, so ids are
those of the whole text. Arrow cuts the texts of a batch and codes equal chunks, so that each
different chunk is looked up once; new words of Latin letters go to the tokenizer's model many to a call.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, text_of

END = 2
END_BYTES = struct.pack("<I", END)
#: Ids of a shard, unless one document has more.
SHARD_IDS = 1 << 20
BLOCK = 512
PERCENTILE = 90
#: Chunks that a Python worker remembers in one generation.
REMEMBER = 250_000
#: Bytes up to which a chunk is remembered.
LONGEST = 64
HEADER = struct.Struct("<4sIIIQIH")
MAGIC = b"PFR1"
#: A text may be cut in front of this: a piece begins with the space, or the line feed is one.
CUT = re.compile(r"[ \n](?<=\S[ \n])(?=\S)")
#: A space or line feed next to other white space; without one, a text may be cut at every one of them.
_WHITE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CROWDED = f"[ \\n][{_WHITE}]|[{_WHITE}][ \\n]"
#: Stands at the cuts of a text; texts that hold it are encoded whole.
SEP = "\0"
#: Bytes of texts that are encoded together.
TOGETHER = 1 << 24
#: Words that one call to the library encodes.
WORDS = 20_000
#: Latin letters, which are one piece, and ASCII marks behind them, which are another.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = f"^[ \\n][{LETTERS}]+$"
MARKS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
NOT_MARKS = " \n" + "".join(c for c in map(chr, range(0x250)) if re.match(f"[{LETTERS}]", c))
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
#: How the byte-level pre-tokenizer spells each byte.
SPELT = np.arange(256, dtype="<u2")
SPELT[[byte for byte in range(256) if byte not in _PLAIN]] = 0x100 + np.arange(256 - len(_PLAIN))


# ---- patched frame of reference -------------------------------------------------------

def _bits(values: np.ndarray) -> np.ndarray:
    """Bits needed for each value below 2 ** 32."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values, each row packed at ``width`` bits."""
    bits = np.empty((*values.shape, width), np.uint8)
    for i in range(width):
        bits[:, :, i] = (values >> np.uint32(i)) & np.uint32(1)
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _unpacked(rows: np.ndarray, width: int, length: int) -> np.ndarray:
    bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :length * width].reshape(len(rows), length, width)
    out = np.zeros((len(rows), length), np.uint32)
    for i in range(width):
        out |= bits[:, :, i].astype(np.uint32) << np.uint32(i)
    return out


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[bytes, bytes]:
    """(index, payload) of the ids; the last block is filled up with its own minimum."""
    count = -(-len(ids) // block)
    if not count:
        return b"", b""
    filled = np.empty(count * block, np.uint32)
    filled[:len(ids)] = ids
    filled[len(ids):] = ids[(count - 1) * block:].min() if len(ids) else 0
    rows = filled.reshape(count, block)
    least = rows.min(axis=1)
    over = rows - least[:, None]
    place = min(block - 1, -(-block * percentile // 100) - 1)
    width = _bits(np.partition(over, place, axis=1)[:, place])
    odd = over >> width[:, None].astype(np.uint32)
    many = np.count_nonzero(odd, axis=1)
    sizes = (block * width + 7) // 8 + 6 * many
    starts = np.concatenate(([0], np.cumsum(sizes)))
    payload = np.zeros(starts[-1], np.uint8)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        low = over[at] & np.uint32((1 << int(w)) - 1)
        packed = _packed(low, int(w))
        payload[starts[at][:, None] + np.arange(packed.shape[1])] = packed
    for b in np.flatnonzero(many):
        places = np.flatnonzero(odd[b])
        begin = starts[b + 1] - 6 * len(places)
        payload[begin:starts[b + 1]] = np.frombuffer(
            places.astype("<u2").tobytes() + odd[b][places].astype("<u4").tobytes(), np.uint8)
    index = (least.astype("<u4").tobytes() + width.astype("u1").tobytes() + many.astype("<u2").tobytes()
             + starts[:-1].astype("<u8").tobytes())
    return index, payload.tobytes()


def decode_blocks(index: bytes, payload: bytes, count: int, first: int, last: int, block: int = BLOCK) -> np.ndarray:
    """The ids of the blocks ``first`` to ``last`` (excluded) of ``count``."""
    least = np.frombuffer(index, "<u4", count)[first:last]
    width = np.frombuffer(index, "u1", count, 4 * count)[first:last]
    many = np.frombuffer(index, "<u2", count, 5 * count)[first:last]
    starts = np.frombuffer(index, "<u8", count, 7 * count)[first:last].astype(np.int64)
    data = np.frombuffer(payload, np.uint8)
    out = np.zeros((last - first, block), np.uint32)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            out[at] = _unpacked(data[starts[at][:, None] + np.arange((block * int(w) + 7) // 8)], int(w), block)
    for b in np.flatnonzero(many):
        begin = starts[b] + (block * int(width[b]) + 7) // 8
        n = int(many[b])
        places = np.frombuffer(payload, "<u2", n, begin)
        out[b][places] |= np.frombuffer(payload, "<u4", n, begin + 2 * n) << np.uint32(width[b])
    return (out + least[:, None]).ravel()


class Shard:
    """A shard file in memory; ids are decoded block by block, on demand."""

    def __init__(self, content: bytes):
        magic, self.task, self.number, docs, self.n_ids, self.blocks, self.block = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEADER.size
        ids = np.frombuffer(content, "<i8", docs, at)
        nulls = np.frombuffer(content, "u1", docs, at + 8 * docs)
        self.sizes = np.frombuffer(content, "<u8", docs, at + 9 * docs).astype(np.int64)
        at += 17 * docs
        self.doc_ids = [None if null else value for value, null in zip(ids.tolist(), nulls.tolist(), strict=True)]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.index = content[at:at + 15 * self.blocks]
        self.payload = memoryview(content)[at + 15 * self.blocks:]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at places ``start`` to ``stop`` of the shard; reads only the blocks they lie in."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        found = decode_blocks(self.index, self.payload, self.blocks, first, last, self.block)
        return found[start - first * self.block:stop - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))


def shard_bytes(task: int, number: int, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    index, payload = encode_blocks(ids)
    header = HEADER.pack(MAGIC, task, number, len(doc_ids), len(ids), len(index) // 15, BLOCK)
    return b"".join((
        header, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids),
        np.array(sizes, "<u8").tobytes(), index, payload))


# ---- tokenizer ------------------------------------------------------------------------

class Encoder:
    """Ids of texts, as little-endian uint32, by a tokenizer of the tokenizers library.

    Chunks are remembered in two generations: when the younger is full it replaces the
    older, and what is met again moves up, so frequent chunks stay. Texts are encoded whole
    unless the tokenizer is byte-level and has no added token that a cut or a plain word could touch.
    """

    def __init__(self, description: str, remember: int = REMEMBER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(description)
        before = parts["pre_tokenizer"] or {}
        touched = re.compile(rf"(?s).*\s.*|[{LETTERS}]+[{re.escape(MARKS)}]*")
        self.byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not (
            before["add_prefix_space"] or parts["normalizer"]) and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or touched.fullmatch(t["content"]) for t in parts["added_tokens"])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        #: For what stands in front of a word: the model behind a cut there, and the ids that begin with it.
        self.models = {}
        for front, behaviour in ((" ", "merged_with_next"), ("\n", "isolated")):
            spelt = chr(SPELT[ord(front)])
            model = Tokenizer(self.tokenizer.model)
            model.pre_tokenizer = Split(spelt, behaviour)
            opening = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
            opening[[i for token, i in vocabulary.items() if token.startswith(spelt)]] = True
            self.models[front] = model, opening
        self.marks: dict[str, bytes] = {"": b""}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.remember = remember

    def ids(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text."""
        if not len(texts):
            return []
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        whole = pc.match_substring(texts, SEP).to_numpy(zero_copy_only=False) if self.byte_level else np.ones(len(texts), bool)
        cut = pc.split_pattern(self._marked(pc.if_else(pa.array(whole), "", texts)), SEP)
        coded = cut.values.dictionary_encode()
        laid = self._of_chunks(coded.dictionary).take(coded.indices)
        ends = np.frombuffer(laid.buffers()[1], np.int64)[cut.offsets.to_numpy()].tolist()
        data = memoryview(laid.buffers()[2] or b"")
        found = [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(whole).tolist():
            found[i] = self._encoded([texts[i].as_py()])[0]
        return found

    def _encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of texts by the whole tokenizer."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    @staticmethod
    def _marked(texts: pa.Array) -> pa.Array:
        """The texts with ``SEP`` where they may be cut."""
        marked = pc.replace_substring(pc.replace_substring(texts, " ", f"{SEP} "), "\n", f"{SEP}\n")
        crowded = pc.match_substring_regex(texts, CROWDED)
        if not pc.any(crowded).as_py():
            return marked
        some = [CUT.sub(rf"{SEP}\g<0>", t) for t in texts.filter(crowded).to_pylist()]
        return pc.replace_with_mask(marked, crowded, pa.array(some, pa.large_string()))

    def _of_chunks(self, chunks: pa.Array) -> pa.Array:
        """Ids of different chunks; those of Latin letters, perhaps with marks behind, are put together from both."""
        bare = pc.utf8_rtrim(chunks, characters=MARKS)
        plain = pc.match_substring_regex(bare, PLAIN)
        words = pc.if_else(plain, bare, chunks).dictionary_encode()
        tails = pc.if_else(plain, pc.utf8_ltrim(chunks, characters=NOT_MARKS), "").dictionary_encode()
        if len(self.marks) > self.remember:
            self.marks = {"": b""}
        for marks in _listed(tails.dictionary):
            if marks not in self.marks:
                self.marks[marks] = array("I", self.tokenizer.encode(marks, add_special_tokens=False).ids).tobytes()
        ends = [self.marks[marks] for marks in _listed(tails.dictionary)]
        return pc.binary_join_element_wise(
            pa.array(self._remembered(words.dictionary), pa.large_binary()).take(words.indices),
            pa.array(ends, pa.large_binary()).take(tails.indices), pa.scalar(b"", pa.large_binary()))

    def _remembered(self, words: pa.Array) -> list[bytes]:
        """Ids of different words and other chunks, remembered or new."""
        if len(self.known) > self.remember:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        spelt = _listed(words)
        found = list(map(known.get, spelt))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = older.get(spelt[i])
        new = np.array([i for i, ids in enumerate(found) if ids is None], np.int64)
        plain = pc.match_substring_regex(words.take(pa.array(new)), PLAIN).to_numpy(zero_copy_only=False)
        at = new[plain]
        for i, ids in zip(at.tolist(), self._words(words.take(pa.array(at))), strict=True):
            found[i] = ids
        others = new[~plain].tolist()
        for start in range(0, len(others), 1000):
            some = others[start:start + 1000]
            for i, ids in zip(some, self._encoded([spelt[i] for i in some]), strict=True):
                found[i] = ids
        known.update(zip(spelt, found, strict=True))
        for i in np.flatnonzero(pc.binary_length(words).to_numpy() > LONGEST).tolist():
            del known[spelt[i]]
        return found

    def _words(self, words: pa.Array) -> list[bytes]:
        """Ids of Latin words with a space or line feed in front, many to a call; the ids that open a word tell them apart."""
        found: list[bytes | None] = [None] * len(words)
        for front, (model, opening) in self.models.items():
            places = np.flatnonzero(pc.starts_with(words, front).to_numpy(zero_copy_only=False))
            for start in range(0, len(places), WORDS):
                at = places[start:start + WORDS]
                some = words.take(pa.array(at))
                spelt = SPELT[np.frombuffer("".join(_listed(some)).encode(), np.uint8)].tobytes().decode("utf-16-le")
                ids = np.array(model.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
                begins = np.flatnonzero(opening[ids])
                if len(begins) == len(at):
                    data, ends = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
                    each = [data[a:b] for a, b in zip(ends, ends[1:])]
                else:
                    each = self._encoded(_listed(some))
                for i, word in zip(at.tolist(), each, strict=True):
                    found[i] = word
        return found


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


_encoders: dict[int, Encoder] = {}


def encoder(description: str) -> Encoder:
    """The worker's encoder; kept between the tasks of a Python worker."""
    key = zlib.crc32(description.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(description)
    return _encoders[key]


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], pa.Array]]:
    """(doc_ids, texts) of about ``TOGETHER`` bytes at a time."""
    for batch in batches:
        doc_ids, texts = batch.column(0), batch.column(1).cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            stop = 1 + int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOGETHER))
            yield doc_ids[at:stop].to_pylist(), texts[at:stop]
            at = stop


# ---- Spark ------------------------------------------------------------------------------

def write(docs: DataFrame, folder: str, tokenizer_path: str, shard_ids: int = SHARD_IDS) -> None:
    """Writes the shards of ``docs`` (doc_id integer, text) into ``folder``."""
    with open(tokenizer_path, encoding="utf-8") as file:
        description = docs.sparkSession.sparkContext.broadcast(file.read())
    keys = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    # rows alike in all keys must still spread over tasks
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).withColumn(
        "row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row").select("doc_id", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        encode = encoder(description.value).ids
        doc_ids, parts, held = [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            content = shard_bytes(task, number, doc_ids, [len(p) // 4 for p in parts], ids)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for some_ids, texts in together(batches):
            for doc_id, ids in zip(some_ids, encode(texts), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + END_BYTES)
                held += len(parts[-1]) // 4
                if held >= shard_ids:
                    yield close()
                    number, doc_ids, parts, held = number + 1, [], [], 0
        if parts:
            yield close()

    files = ordered.mapInArrow(shards, "content binary").select(F.col("content").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


def read(spark: SparkSession, folder: str, scratch: Scratch) -> DataFrame:
    """One row per document of the shards in ``folder``: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: ids are summed within a shard by its
    reader, over the shards of a task and over the tasks by windows on their totals.
    """
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_py())
                n = len(shard.doc_ids)
                ids = memoryview(shard.ids(0, shard.n_ids).astype("<u4", copy=False)).cast("B")
                ends = (4 * shard.starts).tolist()
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.task] * n, pa.int64()), pa.array([shard.number] * n, pa.int64()),
                     pa.array(shard.doc_ids, pa.int64()), pa.array(shard.starts[:-1], pa.int64()),
                     pa.array(shard.sizes, pa.int64()), pa.array(crcs, pa.int64())],
                    ["task", "shard", "doc_id", "within", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    rows = scratch.write(files.mapInArrow(
        decoded, "task bigint, shard bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"), "read")
    shards = scratch.write(rows.groupBy("task", "shard").agg(F.sum("n_tokens").alias("ids")), "totals")
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = shards.groupBy("task").agg(F.sum("ids").alias("ids")).select(
        "task", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("ahead"))
    earlier = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = scratch.write(shards.select("task", "shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("shift"))
                           .join(tasks, "task").select("task", "shard", (F.col("shift") + F.col("ahead")).alias("first")),
                           "places")
    return rows.join(places, ["task", "shard"]).select(
        "doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
