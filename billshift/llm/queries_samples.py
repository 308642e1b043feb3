"""Registered queries of the operators that search, resample and compare sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift.llm import block_topk, divergence, importance
from billshift.llm.queries_rows import documents


def op11_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return block_topk.top_products(embeddings, F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resampling_scores(documents(spark, sf_dir), benchmark)


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 bit by bit over the UTF-8 bytes of each distinct word.
OP12_SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS list
  FROM documents
), wanted AS (
  SELECT regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS list
  FROM benchmark
), raw AS (
  SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(list) AS w FROM words) GROUP BY ALL
), target AS (
  SELECT w, count(*) AS n FROM (SELECT unnest(list) AS w FROM wanted) GROUP BY ALL
), hashed AS (
  SELECT w, (xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(0, CAST(length(hex(encode(w))) / 2 AS BIGINT)),
        lambda i: ('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)) % 10000 AS bucket
  FROM (SELECT w FROM raw UNION SELECT w FROM target)
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
      ((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM raw) + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM target) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(0, 10000) b(bucket)
  LEFT JOIN (SELECT bucket, sum(n) AS n FROM raw JOIN hashed USING (w) GROUP BY ALL) s USING (bucket)
  LEFT JOIN (SELECT bucket, sum(n) AS n FROM target JOIN hashed USING (w) GROUP BY ALL) t USING (bucket)
), weights AS (
  SELECT doc_id, sum(n * gain) AS weight
  FROM raw JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY ALL
), scores AS (
  SELECT doc_id, len(list) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (doc_id)
), places AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn
  FROM scores
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank
FROM places
"""

OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+') AS list
  FROM documents
), occurrences AS (
  SELECT row, lang, source, unnest(list) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM occurrences GROUP BY ALL HAVING count(DISTINCT row) >= 3
), sizes AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY ALL
), names AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM names LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v) AS q
  FROM names JOIN kept USING (lang) JOIN sizes USING (lang) JOIN totals USING (lang, source)
  LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM names a JOIN names b ON a.lang = b.lang AND a.source <> b.source
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), items AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN summed USING (lang, source, item)
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM items
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

QUERIES = {
    "op11_block_topk": op11_block_topk,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_divergence_audit": op13_divergence_audit,
}
ORACLE = {
    "op11_block_topk": OP11_SQL,
    "op12_importance_resampling": OP12_SQL,
    "op13_divergence_audit": OP13_SQL,
}
