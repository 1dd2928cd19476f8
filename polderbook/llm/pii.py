"""Personal data: exact base patterns, and bootstrapped contextual extraction on top.

Base spans are the leftmost non-overlapping matches of four patterns, dropped if
they fail their check. Bootstrapping looks at every token with a digit or an
``@``. Tokens inside a base span are seeds of its kind. A pattern is the word
before a token with the token's outline (digits 9, letters a). Patterns and the
outlined tokens they surround form a graph that Spark scores in rounds: a
pattern scores the average of its tokens for a kind, damped by its support; a
token scores the best of its patterns. After the last round, tokens of
patterns at ``ACCEPT`` or more become spans of that kind where no base span is.

Base spans are never changed. Null and empty texts have no spans. Rows with a
null ``doc_id`` and repeated rows are searched like others; a pattern counts
distinct tokens, so copies of a document do not raise its score. Positions are
code points, end exclusive. Only functions of Spark SQL are used; the patterns
are possessive where that cannot change a match, so that long runs neither
recurse nor backtrack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, text_of

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this cannot match.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Matches whose ends are summed together, so that a text with very many stays near linear.
CHUNK = 1000
ROUNDS = 3
ACCEPT = 0.8
SUPPORT = 3


def _luhn(digits: Column) -> Column:
    flipped = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(flipped)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(flipped, i, F.lit(1)).cast("int")).otherwise(
            F.pmod(F.substring(flipped, i, F.lit(1)).cast("int") * 2, F.lit(10))
            + F.floor(F.substring(flipped, i, F.lit(1)).cast("int") / 5).cast("int")),
    )
    return total % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: ~F.exists(
        F.split(m, r"\."), lambda p: ~p.rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$")),
    "card": lambda m: F.when(F.length(_digits(m)).between(12, 19), _luhn(_digits(m))).otherwise(F.lit(False)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _running(lengths: Column) -> Column:
    """Running totals of an array of ints, summed within chunks and then across them."""
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")),
        lambda c: F.aggregate(
            F.slice(lengths, c * CHUNK + 1, CHUNK), F.array().cast("array<int>"),
            lambda acc, x: F.array_append(acc, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("sums"))
    joined = F.aggregate(
        chunks, start,
        lambda acc, c: F.struct(
            (acc["at"] + F.element_at(c, -1)).alias("at"),
            F.array_append(acc["sums"], F.transform(c, lambda x: x + acc["at"])).alias("sums")),
    )
    return F.flatten(joined["sums"])


def _matches(frame: DataFrame, pattern: str, needs: str, name: str, text: str = "text") -> DataFrame:
    """``frame`` with array ``name`` of (start, end, match, gap before, gap after) for each match.

    Matches and the pieces between them come from one pattern, so their lengths
    add up to the positions.
    """
    searched = F.when(F.contains(F.col(text), F.lit(needs)), F.col(text)).otherwise(F.lit(""))
    parts = frame.withColumns({
        f"{name}_m": F.regexp_extract_all(searched, F.lit(pattern), F.lit(0)),
    })
    parts = parts.withColumn(f"{name}_g", F.split(F.when(F.size(f"{name}_m") > 0, searched).otherwise(F.lit("")), pattern, -1))
    parts = parts.withColumn(
        f"{name}_s",
        F.when(F.size(f"{name}_m") > 0, _running(F.transform(
            F.arrays_zip(F.col(f"{name}_m").alias("m"), F.slice(f"{name}_g", F.lit(1), F.size(f"{name}_m")).alias("g")),
            lambda x: F.length(x["m"]) + F.length(x["g"])))).otherwise(F.array().cast("array<int>")),
    )
    zipped = F.arrays_zip(
        F.col(f"{name}_m").alias("m"), F.col(f"{name}_s").alias("s"),
        F.slice(f"{name}_g", F.lit(1), F.size(f"{name}_m")).alias("before"),
        F.slice(f"{name}_g", F.lit(2), F.size(f"{name}_m")).alias("after"),
    )
    out = F.transform(zipped, lambda x: F.struct(
        (x["s"] - F.length(x["m"])).alias("start"), x["s"].alias("end"), x["m"].alias("match"),
        x["before"].alias("before"), x["after"].alias("after")))
    return parts.withColumn(name, out).drop(f"{name}_m", f"{name}_g", f"{name}_s")


def _word_before(gap: Column) -> Column:
    return F.lower(F.substring_index(F.rtrim(F.translate(gap, "\n\r\t\f\x0b", "     ")), " ", -1))


def _outline(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, r"[0-9]++", "9"), r"\p{L}++", "a")


def _valid(number: int, kind: str) -> Column:
    kept = F.filter(kind, lambda x: CHECKS[kind](x["match"]))
    return F.transform(kept, lambda x: F.struct(
        x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))


def _number_of(number: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("bigint")


def base_spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, spans, tokens): base spans as (start, kind number, end), and the other candidate tokens."""
    text = text_of()
    # every kind of match, and every candidate token, has a digit or an @
    frame = docs.select("doc_id", F.when(text.rlike("[0-9@]"), text).otherwise(F.lit("")).alias("text"))
    found = []
    for number, kind in enumerate(KINDS):
        frame = _matches(frame, PATTERNS[kind], NEEDS[kind], kind)
        found.append(_valid(number, kind))
    frame = frame.withColumn("spans", F.array_sort(F.concat(*found))).drop(*KINDS)
    frame = _matches(frame, TOKEN, "", "token")
    tokens = F.transform("token", lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.sha2(x["match"], 256).alias("token"),
        F.substring(_outline(x["match"]), 1, 80).alias("outline"), F.substring(_word_before(x["before"]), 1, 80).alias("word")))
    return frame.select(F.monotonically_increasing_id().alias("row"), "doc_id", "spans", tokens.alias("tokens"))


def _score(edges: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int) -> DataFrame:
    """(word, outline, kind, score) of every pattern after ``rounds`` rounds over the graph ``edges``."""
    degree = edges.groupBy("word", "outline").agg(F.count("*").alias("degree"))
    tokens = seeds.withColumn("value", F.lit(1.0))
    for turn in range(rounds):
        patterns = scratch.write(
            edges.join(tokens, "token").groupBy("word", "outline", "kind").agg(
                F.sum("value").alias("gathered"), F.count("*").alias("support"))
            .join(degree, ["word", "outline"])
            .where(F.col("support") >= SUPPORT)
            .select("word", "outline", "kind",
                    (F.col("gathered") / F.col("degree") * (1 - F.lit(0.5) / F.col("support"))).alias("score")),
            f"patterns-{turn}",
        )
        reached = edges.join(patterns.where(F.col("score") >= ACCEPT), ["word", "outline"]).groupBy("token", "kind").agg(
            F.max("score").alias("value"))
        tokens = seeds.withColumn("value", F.lit(1.0)).unionByName(
            reached.join(seeds.select("token"), "token", "left_anti").select(*seeds.columns, "value"))
    return patterns


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    scratch = Scratch(docs.sparkSession, "pii")
    rows = scratch.write(base_spans(docs), "rows")
    tokens = scratch.write(
        rows.select("row", "spans", F.explode("tokens").alias("t")).select(
            "row", "t.*",
            F.try_element_at(F.transform(
                F.filter("spans", lambda s: (s["start"] < F.col("t.end")) & (s["end"] > F.col("t.start"))),
                lambda s: s["kind"]), F.lit(1)).alias("kind"),
        ),
        "tokens",
    )
    edges = scratch.write(
        tokens.where("word <> ''").groupBy("word", "outline", "token").agg(F.max("kind").alias("kind")), "edges"
    )
    seeds = edges.where("kind is not null").groupBy("token").agg(F.max("kind").alias("kind"))
    patterns = _score(edges.drop("kind"), seeds, scratch, rounds)
    strong = scratch.small(
        patterns.where(F.col("score") >= ACCEPT).groupBy("word", "outline").agg(F.max_by("kind", "score").alias("found")),
        "strong",
    )
    added = tokens.where("kind is null and word <> ''").join(strong, ["word", "outline"]).groupBy("row").agg(
        F.collect_list(F.struct("start", F.col("found").alias("kind"), "end")).alias("more"))
    both = rows.drop("tokens").join(added, "row", "left")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"], s["end"])), ",")

    counts = [_number_of(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)]
    more = F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    return both.select(
        "doc_id", *counts, F.sha2(joined(F.col("spans")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("spans", more))).alias("spans"), F.size(more).cast("bigint").alias("n_added"),
    )
