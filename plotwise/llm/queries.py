"""Registered queries of the operators, with DuckDB twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.llm.common import documents
from plotwise.llm.conversation_sql import OP11_SQL
from plotwise.llm.conversations import damaged_report
from plotwise.llm.fingerprints import edited_fingerprints
from plotwise.llm.hard_negatives import hard_negatives
from plotwise.llm.html_text import extract
from plotwise.llm.line_dedup import drop_repeated_lines
from plotwise.llm.mixing import mix
from plotwise.llm.near_dedup import near_duplicates
from plotwise.llm.packing import best_fit_pack
from plotwise.llm.pii import personal_data
from plotwise.llm.quality import quality
from plotwise.llm.token_counts import token_counts
from plotwise.llm.toxicity import toxicity
from plotwise.llm.vector_dedup import near_vectors

#: Word pattern of the contracts, for DuckDB.
_WORD = r"[^\x20\x09-\x0D]+"
_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit packing of every document, in words."""
    return best_fit_pack(documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality cascade over every document."""
    return quality(documents(spark, sf_dir)).drop("rejected_by")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that aren't held out."""
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_duplicates(documents(spark, sf_dir))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syncmer fingerprints of every document and of its edited text."""
    return edited_fingerprints(documents(spark, sf_dir))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of every document."""
    return token_counts(documents(spark, sf_dir))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return (personal_data(documents(spark, sf_dir)).withColumn("base_sha256", F.sha2("base_spans", 256))
            .select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy-balanced mix of all documents."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


_MIX_REPAIR = """
m{i} AS (SELECT source, min(target) - sum((n * base + extra) * size) AS missing FROM x{i} GROUP BY source),
b{i} AS (SELECT x.source, x.size, v.move FROM x{i} x JOIN m{i} m ON x.source IS NOT DISTINCT FROM m.source, (VALUES (1), (-1)) v(move)
  WHERE part > 0 AND size > 0 AND ((move = 1 AND extra < n) OR (move = -1 AND extra > 0)) AND abs(missing - move * size) < abs(missing)
  QUALIFY row_number() OVER (PARTITION BY x.source ORDER BY abs(missing - move * size), size, move) = 1),
x{j} AS (SELECT x.source, x.size, x.n, x.source_size, x.target, x.base, x.part, x.extra + coalesce(b.move, 0) AS extra
  FROM x{i} x LEFT JOIN b{i} b ON x.source IS NOT DISTINCT FROM b.source AND x.size = b.size)"""

#: Newton's root by halving: the dual's slope rises with lambda.
_MIX_TAKEN = "list_sum(list_transform(xs, lambda x, i: ms[i] * least(2.0::DOUBLE, exp(least(({0}) * x, 700.0::DOUBLE)))))"

OP9_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, avg(size) AS mean, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + rk % 3] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM s),
v AS (SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT level AS fit FROM v WHERE cap / w >= level ORDER BY cap / w, rk LIMIT 1),
t AS (SELECT source, source_size, mean, CASE WHEN fit IS NULL THEN cap ELSE least(cap, fit * w) END AS target FROM v LEFT JOIN f ON true),
c AS (SELECT d.source, d.size, count(*) AS n, min(source_size) AS source_size, min(target) AS target,
    CASE WHEN min(mean) > 0 THEN d.size / min(mean) ELSE 0.0::DOUBLE END AS x FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.source, d.size),
g AS (SELECT source, min(target) AS target, list(x) AS xs, list(CAST(n * size AS DOUBLE)) AS ms, sum(n * size) AS mass FROM c WHERE size > 0 GROUP BY source),
h AS (SELECT source, target, xs, ms, -1e6::DOUBLE AS lo, 1e6::DOUBLE AS hi, 0 AS i FROM g WHERE target > 0 AND target < 2.0::DOUBLE * mass * (1 - 1e-12::DOUBLE)
  UNION ALL
  SELECT source, target, xs, ms, CASE WHEN low THEN (lo + hi) / 2 ELSE lo END, CASE WHEN low THEN hi ELSE (lo + hi) / 2 END, i + 1
  FROM (SELECT *, {_MIX_TAKEN.format("(lo + hi) / 2")} < target AS low FROM h WHERE i < 130)),
l AS (SELECT source, CASE WHEN target <= 0 THEN -1e6::DOUBLE ELSE 1e6::DOUBLE END AS lam FROM g WHERE target <= 0 OR target >= 2.0::DOUBLE * mass * (1 - 1e-12::DOUBLE)
  UNION ALL SELECT source, (lo + hi) / 2 FROM h WHERE i = 130),
r AS (SELECT c.source, c.size, c.n, source_size, target, CASE WHEN x = 0 THEN 1000000000
    ELSE CAST(round(least(2.0::DOUBLE, exp(least(coalesce(lam, 0) * x, 700.0::DOUBLE))) * 1000000000) AS BIGINT) END AS rate
  FROM c LEFT JOIN l ON c.source IS NOT DISTINCT FROM l.source),
y AS (SELECT *, rate // 1000000000 AS base, rate % 1000000000 AS part,
    CAST(sum(CASE WHEN size > 0 THEN n * (rate % 1000000000) ELSE 0 END) OVER (PARTITION BY source ORDER BY size ROWS UNBOUNDED PRECEDING) AS HUGEINT) AS upto FROM r),
x0 AS (SELECT source, size, n, source_size, target, base, part, least(n, CASE WHEN size > 0
    THEN (upto + 500000000) // 1000000000 - (upto - n * part + 500000000) // 1000000000 ELSE 0 END) AS extra FROM y),
{_MIX_REPAIR.format(i=0, j=1)},
{_MIX_REPAIR.format(i=1, j=2)}
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies FROM (
  SELECT d.doc_id, d.size, source_size, target,
    base + CASE WHEN row_number() OVER (PARTITION BY d.source, d.size ORDER BY hash, doc_id NULLS FIRST) <= extra THEN 1 ELSE 0 END AS copies
  FROM d JOIN x2 ON d.source IS NOT DISTINCT FROM x2.source AND d.size = x2.size)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines repeated across documents dropped from all but the first."""
    return drop_repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN doc_id > first THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN first IS NULL OR doc_id <= first THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM k LEFT JOIN s USING (key) GROUP BY doc_id
"""


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of every damaged conversation."""
    return damaged_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all of them; every seventh label is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", moved)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate vectors."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_near_dedup": op4_near_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_html_text": op6_html_text,
    "op7_token_counts": op7_token_counts,
    "op8_pii": op8_pii,
    "op9_mix": op9_mix,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversations": op11_conversations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_dedup": op13_vector_dedup,
}
#: op2: the rules of the cascade are evaluated in any order, so SQL needs none.
OP2_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT doc_id, i, list_aggregate(w[i:i + 4], 'string_agg', chr(10)) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, CAST(sum(least(5, coalesce(nxt - i, 5))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: trim(x, {_WS}) <> '') AS l FROM d),
f AS (SELECT d.doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_symbols * 100 > n_words * 10 OR word_chars < n_words * 3 OR word_chars > n_words * 10 OR n_dup_lines * 3 > n_lines
    OR (length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g'))) * 100 > word_chars * 30
    OR (length(t) - length(regexp_replace(t, '!+', '', 'g'))) * 100 > n_words * 10
    OR len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) * 100 > n_words * 20 AS bad FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept FROM b
"""

ORACLES: dict[str, str] = {"op2_quality": OP2_SQL, "op9_mix": OP9_SQL, "op10_line_dedup": OP10_SQL, "op11_conversations": OP11_SQL,
                           "op12_hard_negatives": OP12_SQL}
