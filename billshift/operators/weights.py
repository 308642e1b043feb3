"""A fitted charge regression as a table of weights, and scoring by looking codes up.

Every feature of the regression is one code of one column, so a prediction is the
intercept plus one weight per column. As a table the model can be stored, compared and
joined like any other, and scoring needs no feature vectors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift.functions.names import unused
from billshift.operators.coded import MOST_CODES, predictor

#: The position of the row that holds the intercept.
INTERCEPT = -1
SCHEMA = "position int, code string, level long, feature long, weight double"


def indexed_columns(model: PipelineModel) -> list[str]:
    """Code columns of a fitted pipeline, in stage order."""
    columns = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            columns += stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
    return columns


def model_weights(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``position, code, level, feature, weight``: a row per code, and one for the intercept.

    ``feature`` is the code's place in the vector; the last level of a column, and the
    only one of a constant column, have none and weigh 0. As large as the model,
    which the driver holds anyway.
    """
    regression = next(s for s in model.stages if isinstance(s, LinearRegressionModel))
    parts = [_rows(INTERCEPT, [None], [None], [regression.intercept])]
    for (labels, features), found in zip(vocabulary(model.stages), code_weights(model)):
        parts.append(_rows(len(parts) - 1, labels, features, found))
    return spark.createDataFrame(pa.concat_tables(parts), SCHEMA)


def vocabulary(stages: Sequence[Transformer]) -> list[tuple[list[str], list[int | None]]]:
    """The codes of each position of fitted stages, and each code's feature (None if it has none)."""
    encoded = set(next(s for s in stages if isinstance(s, OneHotEncoderModel)).getInputCols())
    positions, start = [], 0
    for stage in stages:
        if not isinstance(stage, StringIndexerModel):
            continue
        outputs = stage.getOutputCols() if stage.isSet("outputCols") else [stage.getOutputCol()]
        for output, labels in zip(outputs, stage.labelsArray):
            width = len(labels) - 1 if output in encoded else 0
            positions.append((list(labels), [*range(start, start + width), *[None] * (len(labels) - width)]))
            start += width
    return positions


def code_weights(model: PipelineModel) -> list[list[float]]:
    """The weight of every code of ``vocabulary``."""
    coefficients = next(s for s in model.stages if isinstance(s, LinearRegressionModel)).coefficients.toArray()
    return [[0.0 if f is None else float(coefficients[f]) for f in features] for _, features in vocabulary(model.stages)]


def _rows(position: int, codes: Sequence, features: Sequence, weights: Sequence[float]) -> pa.Table:
    levels = range(len(codes)) if position != INTERCEPT else [None]
    return pa.table(
        {
            "position": pa.array([position] * len(codes), pa.int32()),
            "code": pa.array(codes, pa.string()),
            "level": pa.array(levels, pa.int64()),
            "feature": pa.array(features, pa.int64()),
            "weight": pa.array(weights, pa.float64()),
        }
    )


def intercept_of(weights: DataFrame) -> float:
    return weights.where(F.col("position") == INTERCEPT).select("weight").first()[0]


def look_up(
    claims: DataFrame, weights: DataFrame, columns: Sequence[str], value: str
) -> tuple[DataFrame, list[str], list[str]]:
    """``claims`` with the row of ``weights`` for each code column: names of the codes found and of ``value``.

    ``columns`` names the code column of each position. One lookup join per column: Spark
    broadcasts a column's codes while they are small by their stored size and shuffles
    beyond that, splitting a code that fills a partition.
    """
    codes, values = [], []
    for position, column in enumerate(columns):
        codes.append(unused([*claims.columns], f"_code{position}"))
        values.append(unused([*claims.columns, codes[-1]], f"_{value}{position}"))
        lookup = weights.where(F.col("position") == position).select(F.col("code").alias(codes[-1]), F.col(value).alias(values[-1]))
        claims = claims.join(lookup, F.col(column) == F.col(codes[-1]), "left")
    return claims, codes, values


def held_weights(weights: DataFrame, columns: Sequence[str]) -> tuple[list, list, float] | None:
    """Codes and weights of each position and the intercept, where a task can hold them.

    None if there are more than ``MOST_CODES``, a code twice at a position, or one without a weight.
    """
    rows = weights.select("position", "code", "weight").limit(MOST_CODES + 2).collect()
    codes: list[list[str]] = [[] for _ in columns]
    values: list[list[float]] = [[] for _ in columns]
    intercept = [w for p, _, w in rows if p == INTERCEPT]
    for position, code, weight in rows:
        if 0 <= position < len(columns) and code is not None:
            codes[position].append(code)
            values[position].append(weight)
    plain = len(intercept) == 1 and None not in [*intercept, *sum(values, [])] and all(len({*c}) == len(c) for c in codes)
    return (codes, values, intercept[0]) if plain and len(rows) <= MOST_CODES + 1 else None


def score_by_weights(claims: DataFrame, weights: DataFrame, columns: Sequence[str], joined: bool = False) -> DataFrame:
    """``claims`` with ``scored`` and ``prediction``; no prediction where a code is null or has no weight.

    ``weights``: ``position, code, weight`` and the intercept's row; ``columns`` as for
    ``look_up``. Columns of the two names are replaced. Every task holds a small table, in Python; a larger
    one is joined, as any is if ``joined``.
    """
    frame = claims.drop("scored", "prediction")
    names = frame.columns
    held = None if joined else held_weights(weights, columns)
    if held is not None:
        frame = frame.withColumn("prediction", predictor(*held)(*columns))
        return frame.select(*names, F.col("prediction").isNotNull().alias("scored"), "prediction")
    frame, codes, terms = look_up(frame, weights, columns, "weight")
    scored = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in codes], F.lit(True))
    prediction = reduce(lambda a, b: a + b, map(F.col, terms), F.lit(0.0)) + F.lit(intercept_of(weights))
    return frame.select(*names, scored.alias("scored"), F.when(scored, prediction).alias("prediction"))
