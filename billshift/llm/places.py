"""Numbers for the rows of a table, without moving the rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billshift.functions.names import unused
from billshift.sources.writers import materialise

_FILE, _AT = "_metadata.file_path", "_metadata.row_index"


def with_places(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long ``name`` that no two rows share: the row's place in its files.

    A frame that isn't read from Parquet files is written to the shared folder first. A row's
    number is its place in its file plus the rows of the files before, one value per file,
    so it is the same however often the table is read.
    """
    try:
        docs.select(_AT, _FILE)
    except AnalysisException:
        docs = materialise(docs, "placed")
    file, first = unused([*docs.columns, name], "_file"), unused([*docs.columns, name], "_first")
    sizes = docs.groupBy(F.col(_FILE).alias(file)).agg((F.max(F.col(_AT)) + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Written, so that Spark knows its size when it chooses the join.
    offsets = materialise(sizes.select(file, before.alias(first)), "places")
    rows = docs.select("*", F.col(_FILE).alias(file), F.col(_AT).alias(name))
    return rows.join(offsets, file).select(*docs.columns, (F.col(first) + F.col(name)).alias(name))
