"""Token files, phrases, the Merkle manifest and the mix: brute force, round trips, odd rows, clashing names."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from polderbook.llm import decontaminate, merkle, mixing, order_minhash, phrases, token_files
from polderbook.llm.common import Scratch

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = [
    "gone", "key", "row", "_doc_id", "_raw", "_kept", "own_id", "own_raw", "own_hash", "size", "target", "copies",
    "source_size", "place", "total", "tie", "hash", "of", "id", "tree", "digest", "path", "shard", "at", "part",
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    out = []
    for i in range(300):
        n = rng.choice([0, 1, 5, 40, 90])
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", ".\n", "  ", " \t", "! "]) for _ in range(n))
        out.append((rng.randint(0, 400), text, rng.choice(["en", "en", "en", "de", None, "ñ", "z"]), rng.choice(["a", "b", None]), n))
    long = " ".join(rng.choice(words) for _ in range(40_000))
    return [*out, (None, None, None, None, None), (None, "x", "en", "a", 3), (7, "", "en", "a", None), (7, "", "en", "a", None),
            (1000, long, "en", "b", 5), (1001, "solo", "one", "b", 2)]


def frame(spark, rows, *more):
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in more])


# ---- token files ----------------------------------------------------------------------

def test_blocks_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 511, 512, 513, 5000):
        for ids in (rng.integers(0, 60_000, n), np.zeros(n, int), np.where(rng.random(n) < 0.03, 2**32 - 1, 7)):
            ids = ids.astype(np.uint32)
            index, payload = token_files.encode_blocks(ids)
            count = len(index) // 15
            assert (token_files.decode_blocks(index, payload, count, 0, count)[:n] == ids).all()
    mostly = np.where(rng.random(51_200) < 0.05, 50_000, rng.integers(0, 8, 51_200)).astype(np.uint32)
    index, payload = token_files.encode_blocks(mostly)
    assert set(index[400:500]) == {3} and len(payload) < 51_200


def test_shard_reads_single_blocks():
    ids = np.arange(4000, dtype=np.uint32)
    shard = token_files.Shard(token_files.shard_bytes(3, 1, [5, None], [1500, 2500], ids) + b"\n")
    assert (shard.task, shard.number, shard.doc_ids) == (3, 1, [5, None])
    assert shard.ids(700, 1300).tolist() == list(range(700, 1300)) and shard.document(1).tolist() == list(range(1500, 4000))


def test_token_files(spark, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = frame(spark, rows, "row", "content", "task").repartition(4)
    scratch = Scratch(spark, "token-test")
    token_files.write(docs, f"{scratch.folder}/out", path, shard_ids=5000)
    got = sorted(map(tuple, token_files.read(spark, f"{scratch.folder}/out", scratch).collect()), key=lambda r: r[1])
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END], "<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert collections.Counter((r[0], r[2], r[3]) for r in got) == want
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is None, d or 0))
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    token_files.write(docs.limit(0), f"{scratch.folder}/none", path)
    assert token_files.read(spark, f"{scratch.folder}/none", Scratch(spark, "token-none")).count() == 0


def test_encoder_on_odd_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read(), remember=20)
    tokenizer = Tokenizer.from_file(path)
    texts = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "x  y", "don't we'll", "1.5, 2 . 3", "é 中 文!", "a\x1c b",
             "Word. word, word! word", "<|endoftext|> a <|endoftext|>", "tab\t x", "a  b  c", "won't. I'm, you're"]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] + [np.frombuffer(encoder.ids([t])[0], "<u4").tolist() for t in texts]
    assert got == 2 * [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


# ---- phrases --------------------------------------------------------------------------

def brute_phrases(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = {(lang, w[i:i + 2]) for (lang, w), a in found.items() if len(w) == 3 for i in (0, 1) if 100 * a >= 50 * f[lang, w[i:i + 2]]}
    by = collections.defaultdict(list)
    for (lang, w), a in found.items():
        if (lang, w) not in inside:
            cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            by[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, items in by.items() for i, (s, a, p, left, right) in enumerate(sorted(items)[:top]))


@pytest.mark.parametrize("bits", [phrases.FILTER_BITS, 1 << 16])
def test_phrases(spark, rows, bits, monkeypatch):
    # a nearly full filter raises false alarms all the time and must not change a count
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    docs = frame(spark, rows * 2, "shard", "w0", "n", "since").repartition(3)
    got = sorted(map(tuple, phrases.collocations(docs, least=4, top=40).collect()))
    assert got == brute_phrases(rows * 2, 4, 40) and len({r[0] for r in got}) > 3


def test_phrases_of_nothing(spark, rows):
    assert phrases.collocations(frame(spark, rows).limit(0)).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None, None, None), (2, "", "en", None, 1)])).count() == 0


def test_phrase_counts_are_whole_when_a_place_is_taken_early(spark, monkeypatch):
    # the words are frequent after the second shard only; their pair's place in the filter is taken after the first
    bits = 1 << 15

    def name(word):
        return int(next(phrases.Words(0).steps(["en"], pa.array([word])))[0][0])

    word = name("again")
    place = (word ^ int(phrases._rotated(np.uint64(word)))) & (bits - 1)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    early = next(w for w in map("early{}".format, range(1_000_000)) if name(w) & (bits - 1) == place)
    shards = spark.createDataFrame(
        [("en", ". ".join([early] * 10), 0), ("en", "again again again", 0), ("en", ". ".join(["again again again"] * 5), 1),
         ("en", ". ".join(["again again again"] * 5), 2)], "lang string, text string, shard int")
    got = {(r["k"], r["n"]) for r in phrases.counted(shards, Scratch(spark, "early")).collect() if r["k"] > 1}
    assert got == {(2, 22), (3, 11)}


def test_phrases_of_long_words_of_regular_build(spark):
    one, other = "a", "b"
    for _ in range(11):
        one, other = one + other, other + one
    got = phrases.collocations(frame(spark, [(1, f"{one} {other}. {other} {one}", "en", None, 1)] * 10)).collect()
    assert sorted((r["phrase"], r["a"], r["l"], r["r"], r["n"]) for r in got) == [
        (f"{one} {other}", 10, 20, 20, 40), (f"{other} {one}", 10, 20, 20, 40)]


def test_phrase_steps_cut_between_pieces(rows, monkeypatch):
    import pyarrow as pa

    texts = pa.array([r[1] or "" for r in rows])
    langs = ["en"] * len(rows)
    whole = [x for step in phrases.Words(0).steps(langs, texts) for x in step[0].tolist()]
    monkeypatch.setattr(phrases, "STEP_BYTES", 50)
    assert [x for step in phrases.Words(0).steps(langs, texts) for x in step[0].tolist()] == whole


def test_partial_counts_of_phrases_hold_every_phrase_once():
    rng = np.random.default_rng(4)
    names = rng.integers(1, 2**63, 50).astype(np.uint64)
    counts, want = phrases.Counts(3), collections.Counter()
    for _ in range(5):
        columns = [names[rng.integers(0, 50, 4000) ** 2 // 50] for _ in range(3)]
        counts.add(*columns)
        want.update(zip(*[c.tolist() for c in columns]))
    got = counts.take().to_pylist()
    assert {(r["w0"], r["w1"], r["w2"]): r["n"] for r in got} == want and len(got) == len(want) and counts.held == 0


def test_phrase_counts_are_summed_after_the_shuffle_alone(spark, rows, monkeypatch):
    # counts leave a task already summed, so another sum before the shuffle finds next to nothing to join
    plans, write = {}, Scratch.write

    def noted(self, frame, name):
        plans[name] = frame._jdf.queryExecution().sparkPlan().toString() + frame._jdf.queryExecution().executedPlan().toString()
        return write(self, frame, name)

    monkeypatch.setattr(Scratch, "write", noted)
    shards = spark.createDataFrame([(r[2] or "und", r[1] or "", i % 3) for i, r in enumerate(rows)], "lang string, text string, shard int")
    assert phrases.counted(shards, Scratch(spark, "plans"), least=4).count()
    states = [plan for name, plan in plans.items() if name.startswith("state-")]
    assert len(states) > 3 and all("HashAggregate" in p and "HashAggregate" not in p.rpartition("Exchange")[2] for p in states)


# ---- manifest -------------------------------------------------------------------------

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def paths_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels[-1][0], [
        [(level[(i >> up) ^ 1] if ((i >> up) ^ 1) < len(level) else None, (i >> up) % 2 == 1) for up, level in enumerate(levels[:-1])]
        for i in range(len(leaves))]


def test_manifest(spark, rows, monkeypatch):
    monkeypatch.setattr(merkle, "STEP", 2)
    docs = frame(spark, rows, *CLASHING).repartition(3)
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    keyed = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("key"), merkle.leaf(*map(F.col, columns)).alias("digest"),
                        F.struct("doc_id").alias("row"))
    scratch = Scratch(spark, "merkle-test")
    proven = merkle.proofs(merkle.build(keyed, scratch, "row"), scratch, "row")
    got = proven.select("tree", "row.doc_id", "digest", "subroot", "root", F.transform("path", lambda s: F.struct(s["digest"], s["left"])),
                        merkle.fold(F.col("digest"), F.col("path")).alias("folded"), merkle.proof_digest(F.col("path")).alias("proof")).collect()
    trees = collections.defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        spelt = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text))
        trees[lang].append((doc_id is None, doc_id or 0, h(spelt), doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    below = {name: paths_of([leaf for _, _, leaf, _ in sorted(trees[name], key=lambda t: t[:3])]) for name in names}
    root, above = paths_of([below[name][0] for name in names])
    want = []
    for place, name in enumerate(names):
        for (_, _, leaf, doc_id), path in zip(sorted(trees[name], key=lambda t: t[:3]), below[name][1]):
            whole = path + above[place]
            want.append((name, doc_id, leaf, below[name][0], root, whole, root, h("".join(d or "" for d, _ in whole))))
    mine = [(*r[:5], [tuple(s) for s in r[5]], r[6], r[7]) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)


def test_manifest_notices_a_change_and_takes_no_rows(spark):
    docs = frame(spark, [(i, f"t{i}", "en", "a", i) for i in range(9)])
    keyed = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("key"), merkle.leaf(F.col("text")).alias("digest"),
                        merkle.leaf(F.concat("text", F.lit("!"))).alias("other"))
    scratch = Scratch(spark, "merkle-test")
    proven = merkle.proofs(merkle.build(keyed, scratch, "other"), scratch, "other")
    folded = proven.select((merkle.fold(F.col("other"), F.col("path")) == F.col("root")).alias("same")).collect()
    assert len(folded) == 9 and not any(r.same for r in folded)
    scratch = Scratch(spark, "merkle-test")
    assert merkle.proofs(merkle.build(keyed.limit(0), scratch, "other"), scratch, "other").count() == 0


# ---- mix, and stages on clashing names --------------------------------------------------

def test_mixed_rows_keep_their_columns(spark, rows):
    docs = frame(spark, rows * 3, *CLASHING, "copy_no").repartition(5)
    taken = collections.Counter()
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"], r["source"], r["tie"]] += r["copies"]
    got = mixing.mixed_rows(docs)
    assert got.columns == [*[c for c in docs.columns if c != "copy_no"], "copy_no"]
    out = collections.Counter((r["doc_id"], r["text"]) for r in got.collect())
    ties = {(r[0], r[1], r[2]): r[3] for r in docs.select("doc_id", "source", mixing._tie(docs), "text").collect()}
    want = collections.Counter()
    for (doc_id, source, tie), n in taken.items():
        want[doc_id, ties[doc_id, source, tie]] += n
    assert out == +want
    assert mixing.mixed_rows(docs.limit(0)).count() == 0


def test_stages_on_clashing_names(spark, rows):
    words = " ".join(f"w{uuid.UUID(int=i).hex[-4:]}" for i in range(30))
    docs = frame(spark, [*rows[:40], (2000, f"start {words} end", "en", "a", 1), (2001, f"start {words} end.", "en", "a", 1)], *CLASHING)
    items = spark.createDataFrame([(None, words), (3, "a b c")], "item_id bigint, text string")
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(r[0]) for r in left.select("doc_id").collect()) == sorted(str(r[0]) for r in rows[:40])
    near = order_minhash.near_dedup(docs)
    ids = [r[0] for r in near.select("doc_id").collect()]
    assert near.columns == docs.columns and 2000 in ids and 2001 not in ids


def test_accented_words_and_broken_lines_go_to_the_model():
    """Ids are those of the whole text; only chunks that are no plain words take the way through the whole tokenizer."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    whole = encoder.tokenizer
    plain = "so École élève, naïf.\nßtraße!!! über&&&\nÿ (öl) Łódź.\nŒuvre... ñ%%% æsir\nþing\nZ x"
    odd = ("a aª b² cⅧ été ×ö ö×ö don't l'école, d'or's x's\ny \nlead trail\n two\n\nlines tab\tbed\n \r\nc a_b é_è "
           "n b é1 1é é.é 中文 é中 x y q\n's w\n.\nv e\x1cf ǆǅ ɐz")
    texts = [plain, odd, f"{odd} {plain}", "", "é", "é\n", "\né", "é\né"]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in texts]

    class Counting:
        chunks = 0

        def encode_batch_fast(self, some, **kwargs):
            self.chunks += len(some)
            return whole.encode_batch_fast(some, **kwargs)

        def encode(self, text, **kwargs):
            return whole.encode(text, **kwargs)

    encoder.tokenizer = counting = Counting()
    assert encoder.ids([plain]) == want[:1]
    assert counting.chunks == 2  # the first chunk, and the one in brackets
    assert encoder.ids(texts) == want


def test_words_met_for_the_first_time_share_calls():
    """Each word goes to the library once, many words to a call, whatever marks, line feeds and texts it stands with."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    calls = []

    class Counting:
        def __init__(self, model):
            self.model = model

        def encode_batch_fast(self, some, **kwargs):
            calls.append(len(some))
            return self.model.encode_batch_fast(some, **kwargs)

    encoder.models = {front: (Counting(model), opening) for front, (model, opening) in encoder.models.items()}
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghiéœ") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    texts = ["".join(w + rng.choice([" ", ", ", ".\n", "\n", "!\n\n", " \n", "; "]) for w in rng.choices(words, k=200)) for _ in range(40)]
    texts += ["\0 a b\n\0c", "a\n", "\n", "\na", " \n a", "a\x85 b  c 　d", "x <|endoftext|> y<|endoftext|>\nz", ""]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.ids(pa.array(texts)) == want and calls == [1, 1]
    assert encoder.ids(pa.array(["-", *texts])[1:]) == want and calls == [1, 1]
    assert encoder.ids(["x " + "y" * 1000]) and max(map(len, encoder.known)) <= token_files.LONGEST


@pytest.mark.parametrize("change", [
    lambda parts: parts["pre_tokenizer"].update(add_prefix_space=True),
    lambda parts: parts["added_tokens"].append({**parts["added_tokens"][0], "id": 50257, "content": "row"}),
    lambda parts: parts["added_tokens"].append({**parts["added_tokens"][0], "id": 50257, "content": "two words"}),
    lambda parts: parts["added_tokens"][0].update(lstrip=True),
])
def test_tokenizers_that_no_cut_is_safe_for_encode_whole_texts(change):
    import json

    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        parts = json.load(file)
    change(parts)
    description = json.dumps(parts)
    texts = ["brown rows, two words <|endoftext|> a\nrow two words", "two\nwords", "a row", ""]
    got = [np.frombuffer(x, "<u4").tolist() for x in token_files.Encoder(description).ids(texts)]
    assert got == [Tokenizer.from_str(description).encode(t, add_special_tokens=False).ids for t in texts]
