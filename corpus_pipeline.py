"""From raw documents to token ids: identify, deduplicate, mix, encode.

Each stage gets what the one before it wrote and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billshift.llm import exact_dedup, jaccard_join, language_id, mixing, sentencepiece
from billshift.llm.queries_texts import PIECES
from billshift.sources.writers import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier recognises."""
    return language_id.keep_identified(docs, language_id.fit_corpus(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of the text; repeated documents stay repeated."""
    return sentencepiece.encode(docs, sentencepiece.load(PIECES))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

#: The classifier, the sketch join, the draw and the merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
