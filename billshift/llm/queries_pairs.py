"""Registered queries of the operators that find pairs and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billshift.llm import jaccard_join, substring_dedup
from billshift.llm.queries_rows import documents


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir)).drop("set_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir)).drop("seq_id")


QUERIES = {"op1_jaccard_join": op1_jaccard_join, "op3_substring_dedup": op3_substring_dedup}
ORACLE: dict[str, str] = {}
