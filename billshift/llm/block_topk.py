"""Exact top-k inner products by block-at-a-time pruning.

Vectors are quantised to integers and ordered so that neighbours are alike; the order
is cut into document-range blocks. A block keeps, per dimension (the terms of a query),
the extremes of its components. The sum of a query's components times the extreme that
helps most bounds every score in the block. A query goes through blocks by falling bound
and scores them from the block's forward index, until the next bound is below its k-th
score so far. All bounds and scores are integers, so the result is exact.

Blocks lie in shards. Each query first searches the shard it lies in itself, which
gives it a k-th score; then it goes only to shards whose own extremes can beat that. Work
is dealt by shard and part of the queries, both of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billshift.operators.ranking import numbered
from billshift.sources.writers import materialise

#: Results per query, and the multiplier before components are floored.
TOP = 5
SCALE = 256
#: Vectors of a block.
BLOCK = 64
#: A shard holds so many vectors, or more where there would be more than SHARDS shards:
#: what every query is compared with, and what is broadcast, is bounded by SHARDS.
SHARD = 8192
SHARDS = 1024
#: Queries that search a shard in one task.
PART = 65_536
#: Vectors that the order is built around: a bounded sample by hash.
PIVOTS = 64
#: Blocks that a query scores between two looks at its bounds.
STEP = 8

#: Bounds held at once, for a number of queries that follows from it.
CELLS = 1 << 22

_ENTRY = "row long, vec_id long, wanted boolean, vector array<long>"
_BLOCKS = "shard long, block long, row array<long>, vec_id array<long>, vectors array<long>"
_QUERY = "shard long, row long, vec_id long, vector array<long>, least long"
_FOUND = "query long, query_id long, row long, vec_id long, score long"


def quantised(vectors: DataFrame, is_query: Column, scale: int = SCALE) -> DataFrame:
    """``row, vec_id, wanted, vector``: floored components; vectors with a null or no finite value are left out.

    ``row`` numbers the rows of the written table, so rows with the same vec_id stay apart.
    """
    value = lambda x: x.cast("double")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")), F.lit(False)))
    usable = vectors.where(F.col("embedding").isNotNull() & finite)
    rows = usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("wanted"),
        F.transform("embedding", lambda x: F.floor(value(x) * float(scale)).cast("long")).alias("vector"),
    )
    return materialise(rows, "topk-vectors")


def matrix(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; short ones are filled with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of integers: in doubles while every partial sum fits 53 bits.

    Scores beyond 64 bits raise an error.
    """
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), np.int64)
    largest = int(abs(a).max()) * int(abs(b).max()) * a.shape[1]
    if largest < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if largest >= 1 << 63:
        raise OverflowError("an inner product may not fit 64 bits")
    return a @ b.T


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Summed term maxima: the most a query can score in each block, ``[query, block]``."""
    return products(np.maximum(queries, 0), high) + products(np.minimum(queries, 0), low)


#: No score, and an id after all others; the former can be negated.
_NONE = np.iinfo(np.int64).min + 1
_LAST = np.iinfo(np.int64).max


def search(
    queries: np.ndarray, own: np.ndarray, least: np.ndarray, blocks: list[np.ndarray], rows: list[np.ndarray],
    ids: list[np.ndarray], top: int = TOP, step: int = STEP,
) -> tuple[np.ndarray, np.ndarray]:
    """The best ``top`` rows of every query in these blocks, best first: scores and places.

    ``own``: each query's own row, which is no candidate. ``least``: scores below it need not
    be found. A place counts through all blocks; it is -1 where there are fewer candidates.
    Equal scores go by smaller id.
    """
    n = len(queries)
    best = np.full((n, top), _NONE)
    best_id = np.full((n, top), _LAST)
    place = np.full((n, top), -1)
    if n == 0 or not blocks:
        return best, place
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
    low, high = (np.stack([f(b, axis=0) for b in blocks]) for f in (np.min, np.max))
    bound = bounds(queries, low, high)
    order = np.argsort(-bound, axis=1, kind="stable")
    at, active = 0, np.arange(n)
    while at < len(blocks) and len(active):
        # A block may hold a tie with a smaller id, so only lower bounds end the search.
        floor = np.maximum(best[active, -1], least[active])
        bound_kept = bound[active, order[active, at]] >= floor
        active = active[bound_kept]
        wave = order[active, at : at + step]
        who, column = np.nonzero(bound[active[:, None], wave] >= floor[bound_kept][:, None])
        chosen = wave[who, column]
        by_block = np.argsort(chosen, kind="stable")
        numbers, begin = np.unique(chosen[by_block], return_index=True)
        for b, members in zip(numbers, np.split(by_block, begin[1:])):
            some = active[who[members]]
            score = products(queries[some], blocks[b])
            score[rows[b] == own[some][:, None]] = _NONE
            near = score.max(axis=1) >= np.maximum(best[some, -1], least[some])
            some, score = some[near], score[near]
            if len(some) == 0:
                continue
            every = np.concatenate([best[some], score], axis=1)
            every_id = np.concatenate([best_id[some], np.broadcast_to(ids[b], score.shape)], axis=1)
            every_place = np.concatenate(
                [place[some], np.broadcast_to(starts[b] + np.arange(len(ids[b])), score.shape)], axis=1
            )
            every_place[every == _NONE] = -1
            kept = np.lexsort((every_id, -every), axis=-1)[:, :top]
            best[some], best_id[some], place[some] = (
                np.take_along_axis(x, kept, axis=1) for x in (every, every_id, every_place)
            )
        at += step
    return best, place


def _ids(column: pa.Array) -> np.ndarray:
    """Ids for ordering; rows without one come last."""
    return column.fill_null(_LAST).to_numpy(zero_copy_only=False)


def _cut(table: pa.Table) -> pa.Table:
    """The blocks of one shard."""
    table = table.sort_by("place")
    ends = [*range(0, table.num_rows, BLOCK), table.num_rows]
    pieces = [table.slice(a, b - a) for a, b in zip(ends, ends[1:])]
    return pa.table(
        {
            "shard": pa.array([p.column("shard")[0].as_py() for p in pieces], pa.int64()),
            "block": pa.array(range(len(pieces)), pa.int64()),
            "row": pa.array([p.column("row").to_pylist() for p in pieces], pa.list_(pa.int64())),
            "vec_id": pa.array([p.column("vec_id").to_pylist() for p in pieces], pa.list_(pa.int64())),
            "vectors": pa.array(
                [p.column("vector").combine_chunks().flatten().to_numpy() for p in pieces], pa.list_(pa.int64())
            ),
        }
    )


def _searcher(width: int, top: int):
    """Searches one shard for one part of the queries."""

    def run(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        rows = [np.asarray(r, np.int64) for r in blocks.column("row").to_pylist()] if queries.num_rows else []
        ids = [_ids(pa.array(r, pa.int64())) for r in blocks.column("vec_id").to_pylist()] if rows else []
        vectors = blocks.column("vectors").combine_chunks()
        data, ends = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
        ends = ends - ends[0]
        forward = [data[a:b].reshape(len(r), width) for r, a, b in zip(rows, ends, ends[1:])]
        own, least = (queries.column(c).to_numpy() for c in ("row", "least"))
        vectors, at_once = matrix(queries.column("vector"), width), max(1, CELLS // max(1, len(forward)))
        parts = [
            search(vectors[i : i + at_once], own[i : i + at_once], least[i : i + at_once], forward, rows, ids, top)
            for i in range(0, len(own), at_once)
        ] or [search(vectors, own, least, [], [], [], top)]
        score, place = (np.concatenate(x) for x in zip(*parts))
        query, rank = np.nonzero(place >= 0)
        taken = place[query, rank]
        flat = [x for r in blocks.column("vec_id").to_pylist() for x in r] if rows else []
        return pa.table(
            {
                "query": pa.array(own[query], pa.int64()),
                "query_id": queries.column("vec_id").combine_chunks().take(pa.array(query, pa.int64())),
                "row": pa.array(np.concatenate(rows)[taken] if rows else [], pa.int64()),
                "vec_id": pa.array([flat[t] for t in taken], pa.int64()),
                "score": pa.array(score[query, rank], pa.int64()),
            }
        )

    return run


def _placed(rows: DataFrame, width: int) -> DataFrame:
    """``row, vec_id, wanted, vector, place``: alike vectors side by side.

    Each vector goes to the pivot with the largest inner product, and by that product.
    """
    sample = rows.orderBy(F.xxhash64("vector"), "row").limit(PIVOTS).select("vector")
    pivots = matrix(pa.array([r["vector"] for r in sample.collect()], pa.list_(pa.int64())), width)
    shared = rows.sparkSession.sparkContext.broadcast(pivots.astype(float))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = matrix(batch.column("vector"), width).astype(float) @ shared.value.T
            best = close.argmax(axis=1) if batch.num_rows else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.int32()), pa.array(close[np.arange(len(best)), best])],
                names=["row", "vec_id", "wanted", "vector", "pivot", "close"],
            )

    kept = rows.select("row", "vec_id", "wanted", _filled(F.col("vector"), width).alias("vector"))
    kept = kept.mapInArrow(near, _ENTRY + ", pivot int, close double")
    ordered = numbered(kept, ["pivot", F.col("close").desc(), F.xxhash64("vector"), "row"], "place")
    return ordered.drop("pivot", "close")


def _filled(vector: Column, width: int) -> Column:
    return F.concat(vector, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(vector)))


def top_products(
    vectors: DataFrame, is_query: Column, top: int = TOP, scale: int = SCALE, shard: int = SHARD
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best other rows of each query row.

    ``vectors``: ``vec_id, embedding``; ``is_query`` is a condition on ``vec_id``; other columns
    don't matter. Scores are inner products of the floored components, higher first, then
    the smaller vec_id, rows without one last. Vectors null or with a null or non-finite
    component take no part; shorter vectors count as filled with zeros, an empty one
    scores 0 everywhere. Rows that repeat a vec_id are candidates, and queries, of their
    own. Fewer candidates than ``top`` give fewer rows; an empty table gives none. Numbers
    too large for 64 bits raise an error.
    """
    rows = quantised(vectors, is_query, scale)
    size, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    width = max(width, 1)
    per_shard = max(shard, -(-size // SHARDS))
    sharded = _placed(rows, width).withColumn("shard", F.expr(f"place div {per_shard}"))
    blocks = materialise(sharded.drop("wanted").groupBy("shard").applyInArrow(_cut, _BLOCKS), "topk-blocks")

    # Round one: the query's own shard.
    queries = sharded.where("wanted").select("shard", "row", "vec_id", "vector", F.lit(_NONE).alias("least"))
    run = _searcher(width, top)
    near = blocks.groupBy("shard").cogroup(queries.groupBy("shard")).applyInArrow(run, _FOUND)
    near = materialise(near, "topk-near")

    # Round two: other shards that can hold a score as high as the k-th so far.
    kth = near.groupBy("query").agg(F.when(F.count("*") >= top, F.min("score")).alias("kth"))
    reached = queries.drop("least").join(kth, queries["row"] == kth["query"], "left").select(
        "shard", "row", "vec_id", "vector", F.coalesce("kth", F.lit(_NONE)).alias("least")
    )
    parts = max(1, -(-rows.where("wanted").count() // PART))
    far_queries = reached.mapInArrow(_router(blocks, width), _QUERY)
    far_queries = far_queries.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    dealt = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    far = dealt.groupBy("shard", "part").cogroup(far_queries.groupBy("shard", "part")).applyInArrow(run, _FOUND)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _router(blocks: DataFrame, width: int):
    """Sends each query to the shards, but its own, whose extremes allow its k-th score.

    One row of extremes per shard and there are at most about ``SHARDS`` shards.
    """

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            vectors = batch.column("vectors")
            data, ends = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            ends = ends - ends[0]
            boxes = [data[a:b].reshape(-1, width) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(shards, width), pa.int64()),
                    pa.array(np.tile(np.arange(width), len(boxes)), pa.int64()),
                    pa.array(np.concatenate([b.min(axis=0) for b in boxes]) if boxes else [], pa.int64()),
                    pa.array(np.concatenate([b.max(axis=0) for b in boxes]) if boxes else [], pa.int64()),
                ],
                names=["shard", "dim", "low", "high"],
            )

    cells = blocks.select("shard", "vectors").mapInArrow(extremes, "shard long, dim long, low long, high long")
    boxes = cells.groupBy("shard", "dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    boxes = boxes.sort_values(["shard", "dim"])
    shards = boxes["shard"].to_numpy(np.int64)[::width]
    low, high = (boxes[c].to_numpy(np.int64).reshape(-1, width) for c in ("low", "high"))
    shared = blocks.sparkSession.sparkContext.broadcast((shards, low, high))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, least_of, most_of = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                most = bounds(matrix(batch.column("vector"), width), least_of, most_of)
                own = batch.column("shard").to_numpy()
                least = batch.column("least").to_numpy()
                query, box = np.nonzero((most >= least[:, None]) & (numbers != own[:, None]))
                sent = batch.take(pa.array(query, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[box], pa.int64()), *sent.columns[1:]], names=batch.schema.names
                )

    return route
