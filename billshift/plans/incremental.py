"""The provider profile kept up to date day by day, without reading old claims again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift.operators import effect
from billshift.operators.profiles import merge_profiles
from billshift.sources.readers import read_table
from billshift.sources.writers import publish_increment

_DAY = "run_date"


def _days(spark: SparkSession, path: str) -> list[str]:
    """Days of a dated table: one value per folder."""
    return sorted(str(r[0]) for r in read_table(spark, path).select(_DAY).distinct().collect())


def _of_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    return read_table(spark, path).where(F.col(_DAY) == F.lit(day).cast("date")).drop(_DAY)


def add_day(spark: SparkSession, root: str, day: str, claims: DataFrame, scored: Column) -> DataFrame:
    """Add one day's claims to the profile of all days, and return it as of the last day.

    ``claims`` and ``scored`` as for ``effect.provider_profile``. The day's own profile is
    stored under ``root/days`` and replaces an earlier run of that day; the profile of all
    days up to a day under ``root/snapshots``. A day that comes late or again is followed by
    the snapshots after it, from the stored profiles of their days. Cost: the day's
    claims, and a row per provider for each snapshot written.
    """
    day = date.fromisoformat(day).isoformat()
    days, snapshots = f"{root.rstrip('/')}/days", f"{root.rstrip('/')}/snapshots"
    publish_increment(effect.provider_profile(claims, scored), days, day)
    known = sorted({*_days(spark, days), day})  # a day without claims has no row to tell of it
    before = [d for d in known if d < day]
    for current in [d for d in known if d >= day]:
        profile = _of_day(spark, days, current)
        if before:
            profile = merge_profiles(_of_day(spark, snapshots, before[-1]), profile)
        publish_increment(profile, snapshots, current)
        before.append(current)
    return _of_day(spark, snapshots, before[-1])
