"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (three to five characters, with marks
at its ends) and the whole word, hashed into a table of vectors; a text is the
average of its words. Table and softmax weights are learnt together, so an unseen
misspelling shares the vectors of the n-grams it kept. After training the table
shrinks to one number per entry, the entry's share in the log-odds, and scoring
reads only that.

Training uses at most ``max_docs`` labelled texts, those with the smallest hash
of their id within each label, so the fit is the same on every run and fits the
driver. Scoring is a map over all rows and whole texts. Null and empty texts,
and texts without a word, score by the bias alone. Labels that are null or whose
document is missing are not used; of several labels of a document the largest
counts. Without labelled texts of both kinds every score is the share of toxic
labels, or 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from polderbook.llm.common import text_of

TABLE = 1 << 18
SIZES = (3, 4, 5)
#: Width of the vectors, rounds of training and steps at least, texts per step, step width, weight decay of the used entries.
DIM, ROUNDS, STEPS, BATCH, RATE, DECAY = 6, 5, 120, 64, 0.01, 2e-4
#: Entries in fewer training texts are noise and stay out.
SUPPORT = 8
INIT = 0.02
#: Averages are multiplied by this, since one word in fifty decides.
SCALE = 40.0
#: Bound of the training sample, and of the words a scoring task remembers.
MAX_DOCS = 6000
REMEMBER = 400_000
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W_]+")


def _entries(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(table entry, word number) of every n-gram and whole word."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths)
    keys, owners = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        rolling = rolling[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:] + np.uint64(1)
        if n in SIZES:
            inside = owner[: len(rolling)] == owner[n - 1:]
            keys.append(rolling[inside] * np.uint64(2 * n + 1))
            owners.append(owner[: len(rolling)][inside])
    power = np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat((ends - lengths).astype(np.uint64), lengths)
    spread = (codes + np.uint64(17)) * ((place + np.uint64(1)) * power | np.uint64(1))
    spread ^= spread >> np.uint64(29)
    whole = np.add.reduceat(spread, ends - lengths) if len(words) else spread
    keys.append(whole)
    owners.append(np.arange(len(words)))
    key = np.concatenate(keys) * power
    return (key >> np.uint64(64 - 18)).astype(np.int64), np.concatenate(owners)


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Model:
    """Log-odds per table entry, already scaled, and the bias."""

    def __init__(self, odds: np.ndarray, bias: float):
        self.odds, self.bias = odds, bias

    def of_words(self, words: list[str]) -> list[float]:
        entry, owner = _entries(words)
        total = np.bincount(owner, self.odds[entry], len(words))
        return (total / np.bincount(owner, minlength=len(words))).tolist()

    def score(self, texts: list[str | None], known: dict[str, float]) -> list[float]:
        """Probability of the toxic label; ``known`` keeps the values of words between calls."""
        out = []
        for text in texts:
            words = _words(text)
            new = list({w for w in words if w not in known})
            if len(known) + len(new) > REMEMBER:
                known.clear()
                new = list(set(words))
            for start in range(0, len(new), 20_000):
                part = new[start:start + 20_000]
                known.update(zip(part, self.of_words(part), strict=True))
            odds = self.bias + (sum(map(known.__getitem__, words)) / len(words) if words else 0.0)
            out.append(float(1 / (1 + np.exp(-np.clip(odds, -30, 30)))))
        return out


def train(texts: list[str], labels: list[int], prior: float | None = None, seed: int = 5) -> Model:
    """Adam on mini-batches over the vectors and the softmax weights.

    ``prior``: part of all labels that is toxic, where the sample has another; the bias is moved to it.
    """
    toxic = float(np.mean(labels)) if labels else 0.0
    if not 0 < toxic < 1:
        return Model(np.zeros(TABLE, np.float32), 30.0 if toxic else -30.0)
    number: dict[str, int] = {}
    doc_words, doc_share, doc_ends = [], [], [0]
    for text in texts:
        words = _words(text)
        found, n = np.unique([number.setdefault(w, len(number)) for w in words], return_counts=True)
        doc_words.append(found.astype(np.int32))
        doc_share.append((n / max(1, len(words))).astype(np.float32))
        doc_ends.append(doc_ends[-1] + len(found))
    entry, owner = _entries(list(number))
    order = np.argsort(owner, kind="stable")
    entry = entry[order].astype(np.int32)
    grams = np.bincount(owner, minlength=len(number))
    begin = np.concatenate(([0], np.cumsum(grams)))
    docs_of = np.bincount(np.concatenate(doc_words), minlength=len(number))
    common = np.bincount(entry, np.repeat(docs_of, grams), TABLE) >= SUPPORT
    del number, order, owner
    y = np.asarray(labels)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, INIT, (TABLE, DIM)).astype(np.float32)
    weights = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    bias = np.log(np.array([1 - toxic, toxic], np.float32))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, weights, bias)]
    step = 0
    for _ in range(max(ROUNDS, -(-STEPS * BATCH // len(y)))):
        shuffled = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            chosen = shuffled[at:at + BATCH]
            words = np.concatenate([doc_words[i] for i in chosen])
            share = np.concatenate([doc_share[i] for i in chosen])
            of = np.repeat(np.arange(len(chosen)), [len(doc_words[i]) for i in chosen])
            used, back = np.unique(words, return_inverse=True)
            # word vectors, each an average over its n-grams, made once per step
            n = grams[used]
            first = np.concatenate(([0], np.cumsum(n)[:-1]))
            flat = entry[np.repeat(begin[used] - first, n) + np.arange(n.sum())]
            made = np.add.reduceat(vectors[flat] * common[flat, None], first, axis=0) / n[:, None] if len(used) else np.zeros((0, DIM))
            mean = np.zeros((len(chosen), DIM), np.float32)
            np.add.at(mean, of, made[back] * share[:, None])
            mean *= SCALE
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            p /= len(chosen)
            to_mean = p @ weights.T * SCALE
            to_word = np.zeros((len(used), DIM), np.float32)
            np.add.at(to_word, back, to_mean[of] * share[:, None])
            to_word /= n[:, None]
            touched, where = np.unique(flat, return_inverse=True)
            spread = np.repeat(to_word, n, axis=0) * common[flat, None]
            to_table = np.stack([np.bincount(where, spread[:, d], len(touched)) for d in range(DIM)], 1)
            step += 1
            for value, (m, v), grad, rows in (
                (vectors, moments[0], to_table + DECAY * vectors[touched], touched),
                (weights, moments[1], mean.T @ p, slice(None)),
                (bias, moments[2], p.sum(0), slice(None)),
            ):
                m[rows] = 0.9 * m[rows] + 0.1 * grad
                v[rows] = 0.999 * v[rows] + 0.001 * grad**2
                value[rows] -= RATE * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.999**step)) + 1e-8)
    odds = vectors @ (weights[:, 1] - weights[:, 0]) * SCALE
    start = float(bias[1] - bias[0])
    if prior is not None and 0 < prior < 1:
        start += np.log(prior / (1 - prior)) - np.log(toxic / (1 - toxic))
    return Model(np.where(common, odds, 0).astype(np.float32), float(start))


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the held-out fold; false for a null ``doc_id``."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(text, toxic) of at most ``max_docs`` labelled documents outside the held-out fold."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one_each = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    part = [
        one_each.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        for label, bound in ((1, max_docs // 2), (0, max_docs - max_docs // 2))
    ]
    chosen = F.broadcast(part[0].unionByName(part[1]))
    return docs.select("doc_id", text_of().alias("text")).join(chosen, "doc_id").groupBy("doc_id").agg(
        F.max("text").alias("text"), F.max("toxic").alias("toxic")
    )


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Train on the sample; the bias follows the label share among all usable labels."""
    usable = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    prior = usable.agg(F.avg("toxic")).first()[0]
    rows = training_sample(docs, labels, max_docs).orderBy("doc_id").toLocalIterator()
    texts, marks = [], []
    for row in rows:
        texts.append(row["text"])
        marks.append(int(row["toxic"]))
    return train(texts, marks, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with column ``toxicity``; rows that have one already lose it."""
    columns = [c for c in docs.columns if c != "toxicity"]
    sent = docs.sparkSession.sparkContext.broadcast((model.odds, model.bias))
    out = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = StructType([*out.schema.fields, StructField("toxicity", DoubleType())])
    at = columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, known = Model(*sent.value), {}
        for batch in batches:
            values = ready.score(batch.column(at).to_pylist(), known)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*columns, "toxicity"])

    return out.mapInArrow(scored, schema)
