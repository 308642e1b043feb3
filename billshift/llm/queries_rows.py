"""Registered queries of the operators that decide about single documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift.llm import exact_dedup, language_id, mixing, sharding


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = mixing.mix(documents(spark, sf_dir))
    rows = units.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    size = (F.col("size") / F.col("n")).cast("long")
    return rows.select(
        "doc_id", "source", size.alias("size"), "source_size", "target", (F.col("times") * size).alias("taken")
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit_corpus(docs)
    judged = language_id.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


QUERIES = {
    "op6_exact_dedup": op6_exact_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op9_language_id": op9_language_id,
    "op10_hilbert_shards": op10_hilbert_shards,
}
ORACLE = {"op6_exact_dedup": OP6_SQL}
