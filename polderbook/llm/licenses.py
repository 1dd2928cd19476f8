"""Licence scan by canonical digest lookup.

Known licence texts and document texts go through the same normalisation: lower
case, copyright lines out, equivalent spellings made one, punctuation and white
space to single spaces. The SHA-256 of what remains is hash-joined to the known
digests. A text that is a licence and nothing else matches as a whole; each
line is looked up the same way, which finds one-line notices inside documents.

A text can only match if its first word is that of a known text, so only such
texts and lines are digested. The lookup table is written first and broadcast only if it is small. The set of
ids collected per row is bounded by the known texts. Null and
empty texts match nothing. A null ``doc_id`` is kept, repeated rows give repeated
results. Two known texts with the same digest are reported under the smaller
name. Only functions of Spark SQL are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polderbook.llm.common import Scratch, text_of

# Spellings that count as equal, and public licence texts and notices.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("favour", "favor"), ("organisation", "organization"),
    ("authorisation", "authorization"), ("behaviour", "behavior"), ("whilst", "while"),
    ("wilful", "willful"), ("https", "http"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
)
COPYRIGHT_LINE = r"(?md)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"

_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted"
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
    "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
    "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution."
)
_BSD_THREE = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_BSD_END = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = (
    ("0BSD", f"{_GRANT}. {_ISC_END}"),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", _BSD_TWO + _BSD_END),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THREE + _BSD_END),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0-notice", "Licensed under CC0 1.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", f"{_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}"),
    ("MIT", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")),
    ("MIT-notice", "Released under the MIT License."),
)


def _without_copyright(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"\r\n?", "\n"), COPYRIGHT_LINE, " ")


def _spelled(words: Column) -> Column:
    out = words
    for variant, usual in SPELLINGS:
        out = F.replace(out, F.lit(f" {variant} "), F.lit(f" {usual} "))
    return out


def canonical(text: Column) -> Column:
    """A licence text as it is digested; empty when nothing but copyright lines and punctuation is left."""
    words = F.regexp_replace(_without_copyright(text), r"[^\p{L}\p{N}]+", " ")
    return F.trim(_spelled(F.concat(F.lit(" "), F.trim(words), F.lit(" "))))


def _starts(known: DataFrame) -> list[str]:
    """First words of the known texts, in every spelling; as many as the lookup table has texts at most."""
    first = known.select(F.substring_index(canonical(F.col("text")), " ", 1).alias("w")).distinct().collect()
    words = {r["w"] for r in first} - {""}
    return sorted(words | {v.split(" ")[0] for v, usual in SPELLINGS if usual.split(" ")[0] in words})


def _may_match(text: Column, starts: list[str]) -> Column:
    return F.regexp_extract(text, r"^[^\p{L}\p{N}]*+([\p{L}\p{N}]++)", 1).isin(starts)


def digest_of(canonical_text: Column) -> Column:
    return F.sha2(F.nullif(canonical_text, F.lit("")), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license_id, text) of the texts in ``KNOWN``."""
    return spark.createDataFrame(list(KNOWN), "license_id string, text string")


def known_digests(known: DataFrame) -> DataFrame:
    return known.select("license_id", digest_of(canonical(F.col("text"))).alias("digest")).where(
        "digest is not null").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_digest and license_id (where the whole text matches, else null),
    notices (ids found as lines, sorted, comma-joined), n_notices (lines that match)."""
    scratch = Scratch(docs.sparkSession, "licenses")
    digests = scratch.small(known_digests(known), "digests")
    starts = _starts(known)
    rows = docs.select("doc_id", text_of().alias("text"), _without_copyright(text_of()).alias("bare"))
    whole = scratch.write(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            F.when(_may_match(F.col("bare"), starts), digest_of(canonical(F.col("text")))).alias("text_digest"),
            F.filter(F.split("bare", "\n"), lambda line: _may_match(line, starts)).alias("lines"),
        ),
        "rows",
    )
    notices = (
        whole.select("row", F.explode("lines").alias("line"))
        .select("row", digest_of(canonical(F.col("line"))).alias("digest")).join(digests, "digest")
        .groupBy("row").agg(
            F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"),
            F.count("*").alias("n_notices"))
    )
    return (
        whole.drop("lines").join(digests.withColumnRenamed("digest", "text_digest"), "text_digest", "left")
        .join(notices, "row", "left")
        .select("doc_id", F.when(F.col("license_id").isNotNull(), F.col("text_digest")).alias("text_digest"), "license_id",
                F.coalesce("notices", F.lit("")).alias("notices"),
                F.coalesce("n_notices", F.lit(0).cast("bigint")).alias("n_notices"))
    )
