"""Dates of a run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_day(run_date: str | None) -> Column:
    """The given day, or today. Name the day to make a rerun repeat its result."""
    return F.current_date() if run_date is None else F.lit(run_date).cast("date")
