"""Operators against brute-force versions, and on null, empty, long, repeated and clashing rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from polderbook.llm import (
    components, decontaminate, exact_dedup, licenses, mixing, near, order_minhash, paragraph_dedup, pii, secrets,
    token_counts, toxicity,
)
from polderbook.llm.common import Scratch

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, block int, row string, part string, id string"


def frame(spark, rows):
    """Rows of (doc_id, text, source), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, "en", s, 1, 7, "x", "y", "z") for d, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="module")
def odd(words):
    """Null, empty, blank, long and repeated rows, null ids and sources."""
    rng = random.Random(4)
    long = " ".join(rng.choice(words) for _ in range(30_000))
    plain = " ".join(rng.choice(words) for _ in range(80))
    edited = plain.split(" ")
    edited[40] = "changed"
    return [
        (1, None, "a"), (2, "", None), (3, " \n\t ", "a"), (4, long, "b"), (5, plain, "a"), (5, plain, "a"),
        (6, plain.replace(" ", "\n", 1), None), (7, " ".join(edited), "b"), (None, plain, "b"), (8, "one two", "a"),
    ]


def empty(spark):
    return frame(spark, []).limit(0)


def test_exact_groups(spark, odd):
    got = [tuple(r) for r in exact_dedup.exact_groups(frame(spark, odd)).collect()]
    normal = {}
    for d, t, _ in odd:
        normal.setdefault(re.sub(r"[ \t-\r]+", " ", t or ""), []).append(d)
    assert len(got) == len(odd)
    for text, ids in normal.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in got if r[4] == sha]
        assert sorted(str(r[0]) for r in mine) == sorted(map(str, ids))
        assert {r[1] for r in mine} == {min(i for i in ids if i is not None)}
        assert all(r[2] == len(ids) for r in mine) and sum(r[3] for r in mine) == 1
    kept = exact_dedup.exact_dedup(frame(spark, odd))
    assert kept.columns == frame(spark, odd).columns and kept.count() == len(normal)
    assert exact_dedup.exact_groups(empty(spark)).count() == 0 == exact_dedup.exact_dedup(empty(spark)).count()


def test_mix(spark, words):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["a", "a", "a", "b", "c", None]))
            for i in range(2000)]
    rows += [(None, None, "d"), (3000, "", "d"), (0, "x", "a")]
    got = mixing.mix(frame(spark, rows)).select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5)).select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, again))
    total = sum(r["size"] for r in got)
    by = {r["source"]: r for r in got}
    assert sum(r["target"] for r in by.values()) == pytest.approx(1.5 * total)
    for s, r in by.items():
        taken = sum(x["size"] * x["copies"] for x in got if x["source"] == s)
        assert r["target"] <= 2 * r["source_size"] and abs(taken - r["target"]) <= 130
    assert max(r["copies"] for r in got) <= 2
    assert mixing.mixed_rows(frame(spark, rows)).count() == sum(r["copies"] for r in got)
    assert mixing.mix(empty(spark)).count() == 0


def test_near_classes_equal_all_pairs(spark, words, odd):
    rng = random.Random(6)
    rows = []
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(40, 150))]
        for _ in range(rng.randint(1, 12)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((100 + len(rows), " ".join(text), "a"))
    rows += odd
    found, _ = order_minhash.near_classes(frame(spark, rows))
    got = found.collect()
    texts = {d: re.findall(r"[^\W_]+", (t or "").lower()) for d, t, _ in rows}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts, key=lambda d: (d is None, d))
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = texts[a] == texts[b] or bool(texts[a]) and bool(texts[b]) and order_minhash.alignment(
                order_minhash.kmers(texts[a]), order_minhash.kmers(texts[b])) >= 0
            if same:
                x, y = sorted((root(a), root(b)), key=lambda d: (d is None, d))
                parent[y] = x
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["class_id"]) for r in got} == {(d, root(d)) for d in texts}
    assert sum(r["kept"] for r in got) == len({root(d) for d in texts})
    stayed = order_minhash.near_dedup(frame(spark, rows))
    assert {r["doc_id"] for r in stayed.select("doc_id").collect()} >= {root(d) for d in texts if d is not None}
    assert order_minhash.near_classes(empty(spark))[0].count() == 0


def test_near_dedup_keeps_one_row_of_each_class(spark, words):
    rng = random.Random(13)
    base, other, third = ([rng.choice(words) for _ in range(80)] for _ in range(3))
    copy = lambda text: " ".join([*text[:40], "changed", *text[41:]])
    a, b, c = (" ".join(t) for t in (base, other, third))
    rows = [
        (1, a, "a"), (2, copy(base), "a"), (2, b, "a"),  # id 2: a near copy of 1, and a text of its own
        (3, c, "a"), (3, copy(third), "b"), (4, "alone here", "a"),  # near copies under one id
        (None, copy(base), "a"), (None, copy(other), "a"),  # null ids next to kept documents
        *[(None, " ".join(f"null{i}" for i in range(60)) + end, "a") for end in ("", " x", " x", " y")],
        (5, "same row twice", "a"), (5, "same row twice", "b"), (6, "same row twice", "a"),
    ]
    stayed = order_minhash.near_dedup(frame(spark, rows))
    assert stayed.columns == frame(spark, rows).columns
    got = sorted((str(r["doc_id"]), r["text"].split(" ")[0]) for r in stayed.collect())
    assert got == sorted([("1", base[0]), ("2", other[0]), ("3", third[0]), ("4", "alone"), ("None", "null0"), ("5", "same")])


def test_alignment_needs_order():
    a = [f"w{i}" for i in range(60)]
    moved = a[30:] + a[:30]
    same = order_minhash.kmers(a)
    assert order_minhash.alignment(same, same) == 1.0
    assert order_minhash.alignment(same, order_minhash.kmers(moved)) == -1.0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = components.components(links, Scratch(spark, "chain"), "c").collect()
    assert {(r["id"], r["component"]) for r in got} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def _named_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def _shared(rows, length):
    """Row numbers that share a run of ``length`` words with another row."""
    where = {}
    for n, (_, text, _) in enumerate(rows):
        found = _named_words(text)
        for i in range(len(found) - length + 1):
            where.setdefault(tuple(found[i:i + length]), set()).add(n)
    return set().union(*[owners for owners in where.values() if len(owners) > 1])


def test_paragraphs_whatever_their_lines(spark, words):
    rng = random.Random(7)
    fresh = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [fresh(51) for _ in range(12)]
    rows = []
    for n in range(200):
        body = fresh(rng.randint(0, 160))
        if n % 3 == 0:
            at = rng.randint(0, len(body))
            body[at:at] = passages[n // 3 % 12]
        for at in range(7, len(body), rng.randint(9, 60)):
            body[at] += "\n"
        rows.append((n, " ".join(body), "a"))
    got = paragraph_dedup.repeated_paragraphs(frame(spark, rows)).collect()
    assert _shared(rows, 51) <= {r["doc_id"] for r in got} <= _shared(rows, 18)
    spelt = {n: _named_words(t) for n, t, _ in rows}
    for r in got:
        here = spelt[r["doc_id"]][r["first_word"]:][:r["n_words"]]
        stays = spelt[r["class_doc_id"]][r["class_first_word"]:][:r["n_words"]]
        assert len(here) == 20 and len(set(here) & set(stays)) >= 15
        assert r["kept"] == ((r["doc_id"], r["first_word"]) == (r["class_doc_id"], r["class_first_word"]))


def test_paragraph_classes_are_those_of_all_pairs(spark, words):
    rng = random.Random(17)
    base = [[rng.choice(words) for _ in range(40)] for _ in range(6)]
    rows = []
    for n in range(90):
        body = list(base[n % 6])
        for _ in range(rng.randint(0, 2)):
            body[rng.randrange(40)] = rng.choice(words)
        rows.append((n, " ".join(body), "a"))
    members = paragraph_dedup.pieces(frame(spark, rows))
    marks = {r["id"]: set(r["marks"]) for r in members.collect()}
    parent = {i: i for i in marks}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in marks:
        for b in marks:
            if a < b and len(marks[a] & marks[b]) >= 0.8 * len(marks[a] | marks[b]):
                parent[top(a)] = top(b)
    scratch = Scratch(spark, "paragraph-test")
    found = {r["id"]: r["component"] for r in paragraph_dedup.similar_pieces(scratch.write(members, "members"), scratch).collect()}
    groups = lambda of: {frozenset(i for i in marks if of(i) == of(j)) for j in marks}
    assert groups(lambda i: found.get(i, i)) == groups(top)
    assert len(groups(top)) < len(marks)


def test_paragraphs_on_odd_rows(spark, words, odd):
    text = " ".join(words[:60])
    rows = [(None, text, "a"), (None, text, "a"), (5, text.upper(), None), (6, " ".join(words[:19]), "a"), (7, text + "\n" + text, "a")]
    got = paragraph_dedup.repeated_paragraphs(frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == {None, 5, 7} and {r["class_doc_id"] for r in got} == {5, 7} - {7}
    assert all(r["kept"] == (r["doc_id"] == 5) for r in got)
    twice = [(8, text + " " + text, "a")]
    assert paragraph_dedup.repeated_paragraphs(frame(spark, twice)).count() == 0
    shared = _shared(odd, 51)
    found = paragraph_dedup.repeated_paragraphs(frame(spark, odd)).collect()
    assert {odd[n][0] for n in shared} <= {r["doc_id"] for r in found}
    assert paragraph_dedup.repeated_paragraphs(empty(spark)).count() == 0


def test_paragraphs_at_every_position(spark, words):
    """Passages of 19 to 50 words, of which pieces around anchors alone miss many, are found whole."""
    rng = random.Random(23)
    fresh = lambda n: [rng.choice(words) for _ in range(n)]
    rows = []
    for n in range(0, 240, 2):
        passage = fresh(19 + n % 32)
        for m in (n, n + 1):
            rows.append((m, " ".join(fresh(rng.randint(1, 90)) + passage + fresh(rng.randint(0, 90))), "a"))
    got = paragraph_dedup.repeated_paragraphs(frame(spark, rows)).collect()
    where = {}
    for n, text, _ in rows:
        spelt = _named_words(text)
        for i in range(len(spelt) - 18):
            where.setdefault(tuple(spelt[i:i + 19]), []).append((n, min(i, len(spelt) - 20)))
    want = {p: (min(places), len(places)) for places in where.values() if len({n for n, _ in places}) > 1 for p in places}
    assert {r["doc_id"] for r in got} == _shared(rows, 19) == set(range(240))
    assert {(r["doc_id"], r["first_word"]) for r in got} == set(want)
    assert sum(r["kept"] for r in got) == sum(len({n for n, _ in places}) > 1 for places in where.values())
    assert all(r["class_size"] == 2 and r["class_doc_id"] == r["doc_id"] // 2 * 2 for r in got)


def test_decontamination(spark, words, odd):
    rng = random.Random(8)
    item = [rng.choice(words) for _ in range(30)]
    near = item[:27] + ["zz"] * 3
    broken = [w if i % 4 else "yy" for i, w in enumerate(item)]
    body = [rng.choice(words) for _ in range(5000)]
    bench = spark.createDataFrame(
        [(1, " ".join(item)), (2, "too short"), (3, None)], "item_id bigint, text string")
    rows = [(20, " ".join(body[:2500] + item + body[2500:]), "a"), (21, " ".join(body + near), "a"),
            (22, " ".join(body + broken), "a"), *odd]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(spark, rows), bench).collect()}
    assert got == {(20, 1), (21, 1)}
    stayed = decontaminate.decontaminate(frame(spark, rows), bench)
    assert stayed.count() == len(rows) - 2 and stayed.columns == frame(spark, rows).columns
    assert decontaminate.contaminated(empty(spark), bench).count() == 0


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _passes(kind: str, match: str) -> bool:
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_spans(spark, odd):
    rng = random.Random(9)
    rows = [(100 + i, "".join(rng.choice("ab1234567890.@+-() é\n") for _ in range(rng.randint(0, 90))), "a") for i in range(400)]
    rows += [(1000, "1 2 " * 5000 + "9" * 20_000 + "a" * 20_000 + " a@b.co" * 1500, "a"),
             (1001, "a@b.c_d@e.f 4111 1111-1111 1111 +1 (234) 567 8901) 001.2.3.004 256.1.1.1", "a"), *odd]
    got = {r["doc_id"]: r for r in pii.find(frame(spark, rows)).collect()}
    for d, t, _ in rows:
        spans = sorted((m.start(), n, m.end()) for n, (k, p) in enumerate(PLAIN) for m in re.finditer(p, t or "")
                       if _passes(k, m.group()))
        said = ",".join(f"{PLAIN[n][0]}:{a}:{b}" for a, n, b in spans)
        assert got[d]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[d]["n_email"] == sum(n == 0 for _, n, _ in spans)
    assert pii.find(empty(spark)).count() == 0


def test_bootstrapping_finds_unseen_numbers(spark):
    rows = [(i, f"please ring {'+1 555 010 %04d' % i} today", "a") for i in range(8)]
    rows = [(i, f"dial +1555010{i:04d} today", "a") for i in range(12)] + [(50, "dial +99 later", "a"), (51, "room 12 here", "a")]
    got = {r["doc_id"]: r for r in pii.find(frame(spark, rows)).collect()}
    assert got[50]["spans"] == "phone:5:8" and got[50]["n_added"] == 1
    assert got[51]["spans"] == "" and got[0]["n_added"] == 0


def test_licenses(spark, odd):
    mit = dict(licenses.KNOWN)["MIT"]
    rows = [(1, f"Copyright (c) 2020 Someone\n\n{mit.upper()}", "a"), (2, mit + " extra", "a"),
            (3, "text\nLicensed under the apache licence - version 2.0\nReleased under the MIT License.", "a"), *odd]
    got = {(r["doc_id"], r["license_id"], r["notices"], r["n_notices"])
           for r in licenses.scan(frame(spark, rows), licenses.known_licenses(spark)).collect()}
    assert (1, "MIT", "MIT", 1) in got and (2, None, "", 0) in got
    assert (3, None, "Apache-2.0-notice,MIT-notice", 2) in got and (4, None, "", 0) in got
    assert licenses.scan(empty(spark), licenses.known_licenses(spark)).count() == 0


def test_toxicity_shares_ngrams(spark, words, odd):
    rng = random.Random(10)
    texts, marks = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(30)]
        if i % 4 == 0:
            for _ in range(3):
                text[rng.randrange(30)] = "zquixotic"
        texts.append(" ".join(text))
        marks.append(int(i % 4 == 0))
    model = toxicity.train(texts, marks)
    clean = " ".join(rng.choice(words) for _ in range(30))
    scores = model.score([clean, clean + " zquixotic" * 3, clean + " zquixotik" * 3, None, ""], {})
    assert scores[0] < 0.3 < scores[1] and scores[2] > 3 * scores[0] and scores[3] == scores[4]
    scored = toxicity.score(frame(spark, odd), model)
    assert scored.count() == len(odd) and scored.where("toxicity is null").count() == 0
    assert toxicity.train([], []).score(["x"], {})[0] < 0.01


def test_token_counts_equal_the_library(spark, odd):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary, unknown = token_counts.read_vocabulary()
    library = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always", split=True)
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice("abcé漢字😀 \n▁<>0x41sunk") for _ in range(rng.randint(0, 60))), "a") for i in range(500)]
    rows += odd
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in token_counts.count_tokens(frame(spark, rows)).collect())
    assert got == sorted((str(d), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in rows)


def test_secrets(spark, words, odd):
    rng = random.Random(12)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'{rng.choice(words)} token = "{key()}" {rng.choice(words)}', "a") for i in range(60)]
    rows += [(100 + i, f"{rng.choice(words)} {''.join(rng.choice(words) for _ in range(6))} end", "b") for i in range(60)]
    got = secrets.scan(frame(spark, rows + odd)).collect()
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["is_secret"] == bool(r["label"]) for r in held) >= 0.9 * len(held)
    assert secrets.scan(empty(spark)).count() == 0


def test_pipeline_stages(spark, odd):
    sf = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame(spark, odd), sf)
        assert out.columns == frame(spark, odd).columns and out.count() <= len(odd)
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_odd_sketches_reject_no_similar_pair():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for size in (1, 5, 150, 3000):
        for apart in {0, 1, size // 9, size // 4, size}:
            a = base[:size]
            b = np.concatenate([a[apart:], rng.integers(0, 1 << 63, apart, dtype=np.uint64)])
            columns = near.odd_sketch(np.concatenate([a, b]), np.array([size, size]))
            differing = sum((int(c[0] ^ c[1]) % (1 << 64)).bit_count() for c in columns)
            assert differing <= 2 * apart
            assert apart or not differing
    assert len(near.odd_sketch(base[:4], np.array([4]))) == len(near.ODD)
