"""Numbering rows in an order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billshift.functions.names import unused
from billshift.sources.writers import materialise

#: Row numbers within a partition take the lower bits of Spark's increasing ids.
_ROW_BITS = 33


def numbered(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "rank",
    start: int = 0,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: each row's place in ``order``, counted from ``start``, as a long.

    Rows are range partitioned and sorted, which numbers them within a partition; the
    numbers of rows in the partitions before, one value per partition, are then added.
    With ``within``, which ``order`` must begin with, each group of these columns
    counts for itself: what is added then is one value per group and partition that
    the group reaches into. Groups, also one with a third of all rows, are spread over
    partitions like any other rows. Rows that ``order`` leaves tied are numbered in any
    order; the ordered rows are written out, so a number never changes afterwards.
    An empty table gives an empty table.
    """
    place, part, first, before = (
        unused([*df.columns, name], n) for n in ("_place", "_part", "_first", "_before")
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    stored = materialise(ordered.withColumn(place, F.monotonically_increasing_id()), "numbered")
    stored = stored.withColumn(part, F.shiftright(place, _ROW_BITS))
    # Rows of a group are neighbours, so within a partition its own first row is number 0.
    sizes = stored.groupBy(*within, part).agg(F.count("*").alias(before), F.min(place).alias(first))
    earlier = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    if within:
        keys = [unused([*stored.columns, first, before], f"_key{i}") for i in range(len(within) + 1)]
        offsets = offsets.toDF(*keys, before, first)
        same = stored[part] == offsets[keys[-1]]
        for column, key in zip(within, keys):
            same = same & stored[column].eqNullSafe(offsets[key])
        joined = stored.join(offsets, same)
    else:
        # One row per partition.
        joined = stored.join(F.broadcast(offsets), part)
    number = F.col(place) - F.col(first) + F.col(before) + F.lit(start)
    return joined.select(*df.columns, number.cast("long").alias(name))
