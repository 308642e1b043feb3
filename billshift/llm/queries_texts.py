"""Registered queries of the operators that work on whole texts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift.llm import fingerprints, html_text, secrets, sentencepiece
from billshift.llm.queries_rows import documents

#: The model file; its pieces go to the executors with the job.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sentencepiece.encode(docs, sentencepiece.load(PIECES))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document stands for a repository, its source for the owner."""
    return secrets.scan(documents(spark, sf_dir), F.col("doc_id"), F.col("source")).drop("findings")


def op5_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(documents(spark, sf_dir))


QUERIES = {
    "op2_sentencepiece": op2_sentencepiece,
    "op4_secret_scan": op4_secret_scan,
    "op5_host_suffix_array": op5_host_suffix_array,
    "op8_syncmer_fingerprints": op8_syncmer_fingerprints,
}
