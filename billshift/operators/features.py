"""Code columns -> indexed, one-hot encoded, assembled feature vector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators.ranking import numbered
from billshift.sources.writers import materialise


def stage_columns(kind: str) -> list[str]:
    return [c.upper() for c in fixed.code_columns(kind)]


def _names(columns: Sequence[str], suffix: str) -> list[str]:
    return [f"{c.lower()}_{suffix}" for c in columns]


def code_indexer(columns: Sequence[str]) -> StringIndexer:
    """By descending frequency; rows with a null or unseen code are skipped."""
    return StringIndexer(
        inputCols=list(columns), outputCols=_names(columns, "idx"), handleInvalid="skip"
    )


def code_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """One-hot without the last level."""
    return OneHotEncoder(inputCols=_names(columns, "idx"), outputCols=_names(columns, "enc"))


def assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=_names(columns, "enc"), outputCol="features")


def feature_stages(kind: str) -> list:
    """Unfitted stages of one claim type: three, over all its code columns at once."""
    columns = stage_columns(kind)
    return [code_indexer(columns), code_encoder(columns), assembler(columns)]


def code_entries(columns: Sequence[str]) -> Column:
    """``position, code`` of a row's code columns, up to the first that is missing."""
    entries = F.array(
        *[F.struct(F.lit(i).alias("position"), F.col(c).alias("code")) for i, c in enumerate(columns)]
    )
    first_missing = reduce(
        lambda later, i: F.when(F.col(columns[i]).isNull(), F.lit(i)).otherwise(later),
        reversed(range(len(columns))),
        F.lit(len(columns)),
    )
    return F.slice(entries, F.lit(1), first_missing)


def code_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Vocabulary of every code column: ``position, code, n_rows``.

    Indexers fitted one after another each see only the rows whose earlier codes
    are all present. A row with its first missing code at position p therefore
    counts for the columns before p, which gives the same vocabularies in one scan
    and one shuffle of per-code counts, however many columns there are. Counting
    happens before the shuffle, so a code that fills a third of the rows is one
    small record per task.
    """
    return _count_entries(df.select(F.inline(code_entries(columns))))


def code_levels_by_type(df: DataFrame, kinds: Mapping[str, Sequence[str]], type_column: str) -> DataFrame:
    """``code_levels`` of several claim types, each with its own columns, from one scan.

    ``type_column, position, code, n_rows``; claims of other types are left out.
    """
    entries = F.coalesce(*[F.when(F.col(type_column) == kind, code_entries(columns)) for kind, columns in kinds.items()])
    return _count_entries(df.select(type_column, F.inline(entries)), type_column)


def _count_entries(entries: DataFrame, *by: str) -> DataFrame:
    return entries.groupBy(*by, "position", "code").agg(F.count("*").alias("n_rows"))


def _level_order() -> list[Column | str]:
    return ["position", F.col("n_rows").desc(), "code"]


def ranked_levels(levels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``level``: the index that the fitted stages give a code, from 0 in every column.

    By descending count, then by code, numbered in parallel: a column of very many codes
    is spread over partitions. ``by`` names further keys, such as the claim type.
    """
    keys = [*by, "position"]
    return numbered(levels, [*by, *_level_order()], "level", within=keys)


def label_arrays(levels: DataFrame, columns: int) -> list:
    """The codes of each column in level order, as arrays of the driver's JVM.

    Sorted across the cluster by range and read in order: the driver holds the
    vocabulary, which is part of the model, and nothing else, and no task holds a column.
    ``levels`` is read twice: store it first.
    """
    spark = levels.sparkSession
    sizes = {r["position"]: r["n"] for r in levels.groupBy("position").agg(F.count("*").alias("n")).collect()}
    strings = spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING()
    codes = getattr(levels.orderBy(*_level_order()).select("code")._jdf, "as")(strings).collect()
    arrays, start = [], 0
    for position in range(columns):
        stop = start + sizes.get(position, 0)
        arrays.append(codes[start:stop])
        start = stop
    return arrays


def fit_features(df: DataFrame, kind: str, levels: DataFrame | None = None) -> list[Transformer]:
    """Fitted indexers, encoder and assembler of one claim type.

    ``StringIndexer.fit`` merges every task's counts in a single task; here they
    are grouped and sorted across the cluster and only the vocabulary, which is part of the
    model, comes to the driver. Columns with a single level carry no information and
    cannot be one-hot encoded: they stay indexed, so their null and unseen codes still
    skip rows, and leave the vector. ``levels``: the type's stored ``code_levels``, if at hand.
    """
    columns = stage_columns(kind)
    levels = materialise(code_levels(df, columns), "code-levels") if levels is None else levels
    vocabulary = label_arrays(levels, len(columns))
    empty = [c for c, labels in zip(columns, vocabulary) if len(labels) == 0]
    if empty:
        raise ValueError(f"no claim has a value in {empty} and in every column before")
    # One model per column: the many-column constructor pads shorter label lists with nulls.
    indexers = [_indexer(labels, column, name) for labels, column, name in zip(vocabulary, columns, _names(columns, "idx"))]
    varying = [c for c, labels in zip(columns, vocabulary) if len(labels) > 1]
    # The indexers' output metadata holds the level counts: this fit reads no rows.
    encoder = code_encoder(varying).fit(PipelineModel(indexers).transform(df))
    return [*indexers, encoder, assembler(varying)]


def _indexer(labels, column: str, output: str) -> StringIndexerModel:
    """``StringIndexerModel.from_labels`` for labels that are in the JVM already."""
    model = StringIndexerModel._create_from_java_class("org.apache.spark.ml.feature.StringIndexerModel", labels)
    return model.setInputCol(column).setOutputCol(output).setHandleInvalid("skip")


def constant_columns(stages: Sequence[Transformer]) -> list[str]:
    """Columns that ``fit_features`` left out of the vector."""
    indexers = [s for s in stages if isinstance(s, StringIndexerModel)]
    return [s.getInputCol() for s in indexers if len(s.labels) < 2]
