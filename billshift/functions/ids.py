"""Identifier columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_id(column: str | Column) -> Column:
    """64-bit id; text that is no number becomes null. Ten digits do not fit 32 bits."""
    col = F.col(column) if isinstance(column, str) else column
    return col.try_cast("bigint")
