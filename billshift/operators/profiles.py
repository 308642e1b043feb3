"""Provider profiles that add up: yesterday's and today's make the profile of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billshift import fixed

_STATS = ("avg_incorrect", "stdev_incorrect", "sample_size")


def _squares(deviation: Column, n: Column) -> Column:
    """Sum of squared differences from the mean, from a sample deviation."""
    return F.when(n > 1, deviation * deviation * (n - 1)).otherwise(F.lit(0.0))


def merge_profiles(first: DataFrame, second: DataFrame) -> DataFrame:
    """The profile (``effect.provider_profile``) of two disjoint sets of claims, from theirs.

    Counts add up. Means and deviations are merged pairwise: the joint sum of squares is
    both sums plus the squared distance of the means, weighted, so nothing large cancels.
    One row per provider on either side; claims are not read.
    """
    left, right = first.alias("a"), second.alias("b")
    of = lambda side, column: F.col(f"{side}.{column}")
    joined = left.join(right, of("a", fixed.PROVIDER).eqNullSafe(of("b", fixed.PROVIDER)), "full")
    merged: dict[str, Column] = {}
    for period in fixed.PERIODS:
        avg, dev, size = (f"{name}_{period}" for name in _STATS)
        n1, n2 = (F.coalesce(of(s, size), F.lit(0)) for s in "ab")
        m1, m2 = (F.coalesce(of(s, avg), F.lit(0.0)) for s in "ab")
        n, apart = n1 + n2, m2 - m1
        squares = _squares(of("a", dev), n1) + _squares(of("b", dev), n2) + apart * apart * F.try_divide(n1 * n2, n)
        mean = F.when(n1 == 0, m2).when(n2 == 0, m1).otherwise(m1 + apart * F.try_divide(n2, n))
        merged[avg] = F.when(n > 0, mean)
        merged[dev] = F.when(n > 1, F.sqrt(F.try_divide(squares, n - 1)))
        merged[size] = n
    for column in first.columns:
        if column == fixed.PROVIDER:
            merged[column] = F.coalesce(of("a", column), of("b", column))
        elif column not in merged:
            merged[column] = F.coalesce(of("a", column), F.lit(0)) + F.coalesce(of("b", column), F.lit(0))
    return joined.select(*[merged[c].alias(c) for c in first.columns])
