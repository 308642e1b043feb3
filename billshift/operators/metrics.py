"""Regression metrics as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """rmse, mse, r2, mae and row count over (prediction, label), per group if asked."""
    y = F.col(label).cast("double")
    error = F.col(prediction).cast("double") - y
    rows = df.where(y.isNotNull() & error.isNotNull())
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error * error).alias("mse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(y))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    )


def merge_metrics(tables: Sequence[DataFrame]) -> DataFrame:
    """Metric tables of several models as one, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def row_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("cnt"))
