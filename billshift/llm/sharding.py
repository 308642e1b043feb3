"""Sharding along a Hilbert curve over document metadata.

Language, source, size and id are quantised to a few bits each; the Hilbert index of
the cell orders the documents, and the order is cut into runs of near equal bytes.
A run covers a small box of each dimension, so the minima and maxima of its files
prune for a filter on any of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billshift.sources.writers import materialise

SHARDS = 24
#: Bits per dimension.
BITS = 5
#: Copies of one text stay in one shard while together they are at most this share of it.
WHOLE_GROUP = 0.02


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points ``[n, dims]`` with ``bits`` bits per dimension.

    Walks the bits from the highest: each step undoes the rotation and reflection of
    the sub-cube the point lies in, and the Gray code of what remains is the index.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            inside = (x[i] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def _curve(*cells: Column) -> Column:
    @F.pandas_udf("long")
    def index(frame: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(frame.to_numpy(), BITS))

    return index(F.struct(*[c.alias(f"d{i}") for i, c in enumerate(cells)]))


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _quantiles(rows: DataFrame, name: str) -> list[float]:
    """At most ``2**BITS - 1`` cut points of a numeric column."""
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = rows.agg(F.percentile_approx(name, shares, 1000)).first()[0] or []
    return sorted(set(found))


def _number_cell(value: Column, cuts: list[float]) -> Column:
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value)), F.lit(0))


def _name_cells(rows: DataFrame, name: str) -> DataFrame:
    """Cell of every distinct value: its place by code point among all rows, in ``2**BITS`` steps.

    The windows see one row per distinct value.
    """
    counts = rows.groupBy(name).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col(name).isNotNull(), F.col(name).cast("binary"))
    middle = F.sum("n").over(order) - F.col("n") / 2
    cell = F.floor(middle * (1 << BITS) / F.sum("n").over(Window.partitionBy()))
    return counts.select(F.col(name).alias(f"_{name}"), cell.cast("int").alias(f"{name}_cell"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, lang, source, size, text_crc32, curve, group, shard, slot`` per row of ``docs``.

    ``size``: UTF-8 bytes of the text (a null text has none) plus 8. Rows with equal
    texts take the curve place of their smallest row and lie side by side; a cut
    goes through such a group only where it is larger than ``WHOLE_GROUP`` of a
    shard. ``slot`` numbers the rows of a shard from 0. Rows equal in doc_id and
    text are interchangeable; nulls sort first.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "lang", "source", byte_size(F.col("text")).alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text.cast("binary")).alias("group"),
    )
    rows = materialise(rows, "shard-rows")
    cells = rows
    for name in ("lang", "source"):
        found = _name_cells(rows, name)
        cells = cells.join(found, cells[name].eqNullSafe(found[f"_{name}"]), "left").drop(f"_{name}")
    cells = cells.withColumns(
        {"id_cell": _number_cell(F.col("doc_id"), _quantiles(rows, "doc_id")),
         "size_cell": _number_cell(F.col("size"), _quantiles(rows, "size"))}
    )
    curve = _curve(*[F.col(c).cast("long") for c in ("lang_cell", "source_cell", "size_cell", "id_cell")])
    placed = cells.withColumn("curve", curve)
    groups = placed.groupBy("group").agg(F.min("curve").alias("curve"), F.sum("size").alias("group_bytes"))
    # Partial rows per task keep a group with a third of all rows small here; the join
    # back is one whose skewed side adaptive execution splits.
    ordered = placed.drop("curve").join(groups, "group")
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(total / shards, 1)
    limit = max(1.0, WHOLE_GROUP * share)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = ordered.repartitionByRange(parts, "curve", "group", "doc_id", "size")
    sorted_ = materialise(sorted_.withColumn("part", F.spark_partition_id()), "shard-sorted")

    # Bytes before a row: of earlier partitions (one row each), and of earlier rows here.
    before = sorted_.groupBy("part").agg(F.sum("size").alias("bytes")).select(
        "part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("offset")
    )
    inside = Window.partitionBy("part").orderBy("curve", "group", "doc_id", "size")
    rank = inside.rowsBetween(Window.unboundedPreceding, 0)
    run = sorted_.join(F.broadcast(before), "part").withColumn(
        "end", F.col("offset") + F.sum("size").over(rank)
    )
    # A small group goes where its middle lies, rows of a large one each by their own.
    first = run.groupBy("group").agg(F.min(F.col("end") - F.col("size")).alias("group_start"))
    whole = F.col("group_bytes") <= limit
    middle = F.when(whole, F.col("group_start") + F.col("group_bytes") / 2).otherwise(F.col("end") - F.col("size") / 2)
    run = materialise(
        run.join(first, "group").withColumn("shard", F.least(F.floor(middle / share), F.lit(shards - 1)).cast("int")),
        "shard-run",
    )
    # Slots: rows of the shard in earlier partitions, and in this one.
    held = run.groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part")
    held = held.select(
        F.col("shard").alias("_shard"), F.col("part").alias("_part"),
        (F.sum("n").over(earlier) - F.col("n")).alias("first_slot"),
    )
    here = Window.partitionBy("part", "shard").orderBy("curve", "group", "doc_id", "size")
    numbered = run.withColumn("local", F.row_number().over(here) - 1)
    joined = numbered.join(
        held, (numbered["part"] == held["_part"]) & (numbered["shard"] == held["_shard"])
    )
    return joined.select(
        "doc_id", "lang", "source", "size", "text_crc32", "curve", "group", "shard",
        (F.col("first_slot") + F.col("local")).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order: each file covers a box of the metadata."""
    parts = F.col("shard")
    sharded.repartition(parts).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
