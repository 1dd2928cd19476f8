"""Secret scan: candidate tokens, and a random forest that removes false positives.

Candidates are runs of at least 20 token characters. A forest trained on
labelled findings decides by the candidate's length, its changes between
character classes, shares of digits and distinct characters, how much of it is
dictionary words, the path's and the neighbouring word's record among labelled
findings, and the punctuation around it. The dictionary is counted over all
documents, but only for words that occur inside candidates.

Training uses at most ``max_findings`` labelled findings, those with the smallest
hash per label. Labels come as a column; ``reviewed`` labels findings where none
are given: assigned to a name such as token or password counts as a secret. If
all labels are alike the score is that label. Null and empty texts have no
candidates; null paths are a path of their own; repeated rows are scored alike.
The secret itself is never returned, only its digest and place. Only Spark SQL
functions and Spark's own forest are used.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, text_of
from polderbook.llm.pii import _matches
from polderbook.llm.toxicity import held_out

CANDIDATE = r"(?:\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{20,}+"
NAMES = r"(?i)(token|secret|passw|pwd|api_?key|credential|auth)"
COMMON = 10
MAX_FINDINGS = 20_000
TREES, DEPTH, SEED = 20, 6, 11
FEATURES = (
    "length", "transitions", "digit_share", "distinct_share", "dictionary_share", "path_rate", "word_rate",
    "after_sign", "quoted",
)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, path, start, end, candidate, word, sign, quoted) of every candidate."""
    frame = docs.select("doc_id", F.col("source").alias("path"), text_of().alias("text"))
    found = _matches(frame, CANDIDATE, "", "found").select("doc_id", "path", F.explode(F.transform(
        "found", lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("candidate"),
            F.right(x["before"], F.lit(60)).alias("before"), F.left(x["after"], F.lit(2)).alias("after")))).alias("f"))
    rows = found.select("doc_id", "path", "f.*")
    return rows.select(
        "doc_id", "path", "start", "end", "candidate",
        F.lower(F.regexp_extract("before", r"([\p{L}\p{N}_]++)[^\p{L}\p{N}_]*$", 1)).alias("word"),
        F.regexp_extract("before", r"([=:])\s*[\"']?$", 1).alias("sign"),
        (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).alias("quoted"),
    )


def _pieces(candidate: Column) -> Column:
    return F.filter(F.split(F.lower(candidate), "[^a-z]+"), lambda w: F.length(w) >= 3)


def _dictionary(docs: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(piece) of the words inside candidates that occur at least ``COMMON`` times in ``docs``."""
    asked = scratch.small(found.select(F.explode(_pieces(F.col("candidate"))).alias("piece")).distinct(), "asked")
    words = docs.select(F.explode(F.split(F.lower(text_of()), "[^a-z]+")).alias("piece"))
    return scratch.small(
        words.join(asked, "piece", "left_semi").groupBy("piece").agg(F.count("*").alias("n"))
        .where(F.col("n") >= COMMON).select("piece"), "dictionary"
    )


def _plain(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``found``, a table with unique ``row``, with the features that need no labels."""
    known = (
        found.select("row", F.explode(_pieces(F.col("candidate"))).alias("piece")).join(dictionary, "piece")
        .groupBy("row").agg(F.sum(F.length("piece")).alias("known"))
    )
    text, size = F.col("candidate"), F.length("candidate")
    kinds = F.regexp_replace(text, r"[a-z]++|[A-Z]++|[0-9]++|[^A-Za-z0-9]++", "x")
    return found.join(known, "row", "left").select(
        *found.columns, size.cast("double").alias("length"), (F.length(kinds) / size).alias("transitions"),
        (F.length(F.regexp_replace(text, "[^0-9]", "")) / size).alias("digit_share"),
        (F.size(F.array_distinct(F.split(text, ""))) / F.least(size, F.lit(64))).alias("distinct_share"),
        (F.coalesce("known", F.lit(0)) / size).alias("dictionary_share"),
        (F.col("sign") != "").cast("double").alias("after_sign"), F.col("quoted").cast("double").alias("quoted_as"),
    ).withColumn("quoted", F.col("quoted_as")).drop("quoted_as")


def reviewed(found: DataFrame) -> Column:
    """Label of a finding where no labels are given."""
    return ((F.col("sign") != "") & F.col("word").rlike(NAMES)).cast("int")


def _rates(sample: DataFrame, column: str) -> DataFrame:
    return sample.groupBy(column).agg(
        ((F.sum("label") + F.lit(0.5)) / (F.count("*") + F.lit(1.0))).alias(f"{column}_rate"))


def scan(docs: DataFrame, label: Column | None = None, max_findings: int = MAX_FINDINGS) -> DataFrame:
    """One row per candidate: doc_id, start, end, candidate_sha256, held_out, label, score, is_secret.

    ``label``: 0, 1 or null from the columns of ``candidates``; findings of held-out documents never train.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.write(
        candidates(docs).withColumn("row", F.monotonically_increasing_id())
        .withColumn("label", reviewed(docs) if label is None else label), "found"
    )
    plain = scratch.write(_plain(found, _dictionary(docs, found, scratch)), "plain")
    usable = plain.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    parts = [
        usable.where(F.col("label") == value).orderBy(F.xxhash64("candidate", "doc_id", "start"), "row").limit(max_findings // 2)
        for value in (0, 1)
    ]
    sample = scratch.write(parts[0].unionByName(parts[1]), "sample")
    words, paths = (scratch.small(_rates(sample, c), f"{c}-rates") for c in ("word", "path"))

    def with_rates(frame: DataFrame) -> DataFrame:
        w, p = words.withColumnRenamed("word", "_word"), paths.withColumnRenamed("path", "_path")
        joined = frame.join(w, F.col("word") == F.col("_word"), "left").join(
            p, F.col("path").eqNullSafe(F.col("_path")), "left")
        return joined.select(
            *frame.columns, F.coalesce("word_rate", F.lit(0.5)).alias("word_rate"),
            F.coalesce("path_rate", F.lit(0.5)).alias("path_rate"))

    kinds = sorted(r["label"] for r in sample.select("label").distinct().collect())
    if len(kinds) == 2:
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        forest = RandomForestClassifier(
            labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8
        ).fit(assembler.transform(with_rates(sample)))
        scored = forest.transform(assembler.transform(with_rates(plain))).withColumn(
            "score", vector_to_array("probability")[1])
    else:
        scored = plain.withColumn("score", F.lit(float(kinds[0]) if kinds else 0.0))
    return scored.select(
        "doc_id", "start", "end", F.sha2("candidate", 256).alias("candidate_sha256"),
        held_out(F.col("doc_id")).alias("held_out"), "label", "score", (F.col("score") >= 0.5).alias("is_secret"))
