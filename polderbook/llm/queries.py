"""The operators applied to the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polderbook.llm import (
    decontaminate, exact_dedup, licenses, merkle, mixing, order_minhash, paragraph_dedup, phrases, pii, secrets, token_counts,
    token_files, toxicity,
)
from polderbook.llm.common import Scratch, table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_classes(table(spark, sf_dir, "documents"))[0]


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_paragraphs(table(spark, sf_dir, "documents"))


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "token-files")
    folder = f"{scratch.folder}/shards"
    token_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, folder, scratch)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = merkle.leaf(*parts)
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf(*parts[:3], one_more, parts[4]))
    rows = docs.select(
        F.col("lang").alias("tree"), F.col("doc_id").alias("key"), leaf.alias("digest"),
        F.struct("doc_id", changed.alias("tampered")).alias("row"))
    scratch = Scratch(spark, "merkle")
    proven = merkle.proofs(merkle.build(rows, scratch, "row"), scratch, "row")
    folded = merkle.fold(F.coalesce("row.tampered", "digest"), F.col("path"))
    return proven.select(
        "row.doc_id", F.col("digest").alias("leaf"), "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_pii, op2_licenses, op3_toxicity, op4_decontamination, op5_mix, op6_near_duplicates, op7_token_counts,
        op8_secrets, op9_paragraphs, op10_exact, op11_token_files, op12_phrases, op13_merkle, pipeline,
    )
    return {q.__name__: q for q in named}


_WORDS = r"regexp_replace(lower(coalesce({text}, '')), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')"


def _license_sql() -> str:
    def spelled(text: str) -> str:
        for variant, usual in licenses.SPELLINGS:
            text = f"replace({text}, ' {variant} ', ' {usual} ')"
        return text

    line = licenses.COPYRIGHT_LINE.replace("(?md)", "(?m)")

    def canonical(text: str) -> str:
        bare = f"regexp_replace(regexp_replace(lower({text}), '\\r\\n?', chr(10), 'g'), '{line}', ' ', 'g')"
        words = f"regexp_replace({bare}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
        return f"trim({spelled(f"' ' || trim({words}) || ' '")})"

    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in licenses.KNOWN)
    return f"""
WITH known AS (
  SELECT min(license_id) AS license_id, canon FROM (SELECT license_id, {canonical('t')} AS canon FROM (VALUES {values}) k(license_id, t))
  WHERE canon <> '' GROUP BY canon
),
whole AS (SELECT doc_id, {canonical("coalesce(text, '')")} AS canon FROM documents),
lines AS (
  SELECT doc_id, {canonical('l')} AS canon FROM (
    SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '\\r\\n|\\r|\\n')) AS l FROM documents)
),
notices AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n_notices
  FROM lines JOIN known USING (canon) GROUP BY doc_id
)
SELECT w.doc_id, CASE WHEN k.license_id IS NOT NULL THEN sha256(w.canon) END AS text_digest, k.license_id,
  coalesce(n.notices, '') AS notices, coalesce(n.n_notices, 0) AS n_notices
FROM whole w LEFT JOIN known k USING (canon) LEFT JOIN notices n ON n.doc_id = w.doc_id"""


OP4_SQL = f"""
WITH items AS (
  SELECT DISTINCT item_id, trim({_WORDS.format(text='text')}) AS line FROM benchmark
),
item_words AS (SELECT item_id, line, string_split(line, ' ') AS w FROM items),
item_runs AS (
  SELECT DISTINCT item_id, line, array_to_string(w[i:i + 4], ' ') AS run
  FROM (SELECT item_id, line, w, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5)
),
sizes AS (SELECT item_id, line, count(*) AS n_shingles FROM item_runs GROUP BY ALL),
doc_words AS (
  SELECT doc_id, string_split(trim({_WORDS.format(text='text')}), ' ') AS w FROM documents
),
doc_runs AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words WHERE len(w) >= 5)
),
shared AS (
  SELECT doc_id, item_id, line, count(*) AS n_shared FROM doc_runs JOIN item_runs USING (run) GROUP BY ALL
)
SELECT doc_id, item_id, max(n_shared) AS n_shared, n_shingles
FROM shared JOIN (SELECT item_id AS of_id, line AS of_line, n_shingles FROM sizes) ON of_line = line AND of_id IS NOT DISTINCT FROM item_id
WHERE n_shared >= n_shingles * CAST(0.8 AS DOUBLE)
GROUP BY doc_id, item_id, n_shingles"""

OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight, source_size * 2 AS cap FROM sizes
),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE)
      - CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed
),
chosen AS (SELECT *, max(CASE WHEN level < cap / weight THEN level END) OVER () AS common FROM levels),
targets AS (
  SELECT source, source_size, CASE WHEN level >= cap / weight OR common IS NULL THEN CAST(cap AS DOUBLE) ELSE common * weight END AS target,
    CAST(('0x' || substr(md5('mix-1:' || coalesce(source, chr(0))), 1, 8)) AS BIGINT) / 4294967296.0 AS start
  FROM chosen
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS place FROM sized
),
rated AS (
  SELECT p.doc_id, p.size, p.place, t.source_size, t.target, CAST(t.start AS DOUBLE) AS start,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  least(CAST(floor(start + rate * place) - floor(start + rate * (place - 1)) AS BIGINT), 2) * size AS taken
FROM rated"""

OP10_SQL = r"""
WITH keyed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM keyed WINDOW same AS (PARTITION BY text_sha256)"""


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM documents
),
ones AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM pieces) GROUP BY ALL),
twos AS (
  SELECT lang, w1, w2, count(*) AS f FROM (
    SELECT lang, w[i] AS w1, w[i + 1] AS w2 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM pieces)) GROUP BY ALL
),
threes AS (
  SELECT lang, w1, w2, w3, count(*) AS f FROM (
    SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM pieces))
  GROUP BY ALL HAVING count(*) >= 10
),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang),
longer AS (
  SELECT lang, w1, w2, max(f) AS most FROM (SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL
),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w = t.w1 JOIN ones y ON y.lang = t.lang AND y.w = t.w2
  LEFT JOIN longer g ON g.lang = t.lang AND g.w1 = t.w1 AND g.w2 = t.w2
  WHERE t.f >= 10 AND (g.most IS NULL OR 100 * g.most < 50 * t.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.w = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w = t.w3
),
scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest) JOIN totals USING (lang)
WHERE rank <= 2000"""

OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
),
spelled AS (
  SELECT doc_id, lang,
    concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
      coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS chars,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') AS more,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS changed
  FROM documents, crc_table
),
leaves AS (
  SELECT doc_id, lang, sha256(head || chars || tail) AS leaf,
    CASE WHEN changed THEN sha256(head || more || tail) ELSE sha256(head || chars || tail) END AS shown
  FROM spelled
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS place FROM leaves
),
grown AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM grown WHERE len(nodes) > 1
),
tops AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS top_place FROM grown WHERE len(nodes) = 1
),
over AS (
  SELECT 0 AS level, list(subroot ORDER BY top_place) AS nodes FROM tops
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM over WHERE len(nodes) > 1
),
steps AS (
  SELECT lang, list({'level': level, 'nodes': nodes} ORDER BY level) FILTER (len(nodes) > 1) AS levels FROM grown GROUP BY lang
),
over_steps AS (SELECT list({'level': level, 'nodes': nodes} ORDER BY level) FILTER (len(nodes) > 1) AS levels FROM over),
paths AS (
  SELECT p.doc_id, p.leaf, p.shown, t.subroot, (SELECT nodes[1] FROM over WHERE len(nodes) = 1) AS root,
    list_concat(
      list_transform(coalesce(s.levels, []), lambda l: {'left': (p.place >> l.level) & 1, 'digest': coalesce(l.nodes[xor(p.place >> l.level, 1) + 1], '')}),
      list_transform(coalesce(o.levels, []), lambda l: {'left': (t.top_place >> l.level) & 1, 'digest': coalesce(l.nodes[xor(t.top_place >> l.level, 1) + 1], '')})) AS path
  FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang JOIN steps s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN over_steps o
),
folded AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.digest), '')) AS proof_sha256,
    list_reduce(list_prepend({'left': CAST(0 AS BIGINT), 'digest': shown}, path),
      lambda node, s: {'left': CAST(0 AS BIGINT), 'digest': sha256(CASE WHEN s.left = 1 THEN s.digest || node.digest ELSE node.digest || s.digest END)}).digest AS folded_root
  FROM paths
)
SELECT *, folded_root = root AS verified FROM folded"""


def oracles() -> dict[str, str]:
    import corpus_pipeline

    found = {
        "op2_licenses": _license_sql(), "op4_decontamination": OP4_SQL, "op5_mix": OP5_SQL, "op10_exact": OP10_SQL,
        "op12_phrases": OP12_SQL, "op13_merkle": OP13_SQL,
    }
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
