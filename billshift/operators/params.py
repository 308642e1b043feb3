"""Configuration parameters and the model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift import fixed


def of_model(table: DataFrame, model_id: str) -> DataFrame:
    return table.where(F.col(fixed.CONFIG_MODEL) == model_id)


def params_frame(config: DataFrame, model_id: str) -> DataFrame:
    """Key and value of every config entry of a model."""
    return of_model(config, model_id).select(fixed.CONFIG_KEY, fixed.CONFIG_VALUE)


def last_params(config: DataFrame, order_by: str | None = None) -> DataFrame:
    """One value per model and key: the last by ``order_by``, else the greatest."""
    value = F.col(fixed.CONFIG_VALUE)
    rank = value if order_by is None else F.struct(F.col(order_by), value)
    return config.groupBy(fixed.CONFIG_MODEL, fixed.CONFIG_KEY).agg(
        F.max_by(value, rank).alias(fixed.CONFIG_VALUE)
    )


def params_map(config: DataFrame, order_by: str | None = None) -> DataFrame:
    """One key -> value map per model; its size is the model's distinct keys."""
    entry = F.struct(fixed.CONFIG_KEY, fixed.CONFIG_VALUE)
    return (
        last_params(config, order_by)
        .groupBy(fixed.CONFIG_MODEL)
        .agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("params"))
    )


def missing_models(requested: DataFrame, registry: DataFrame, key: str = fixed.CONFIG_MODEL) -> DataFrame:
    """Requested model ids the registry does not hold."""
    return requested.select(key).distinct().join(registry.select(key), key, "left_anti")


def has_model(registry: DataFrame, model_id: str) -> bool:
    """Whether the registry holds a model; reads at most one row."""
    return not of_model(registry, model_id).isEmpty()
