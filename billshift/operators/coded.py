"""Passes over claims with their codes looked up in a vocabulary that a task holds.

Codes are looked up a column and a batch at a time, in Arrow: no row of a vector and no row
per code or pair of codes is ever made. For vocabularies of at most ``MOST_CODES`` codes,
which every task gets; callers join beyond that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_CODES = 4096
#: Claims that are counted at a time.
_ROWS = 1 << 17
_MOMENTS = "a int, b int, n long, labels double, squares double"


def _places(column: pa.Array, codes: Sequence[str]) -> np.ndarray:
    """Where each value stands in ``codes``, -1 for null and unseen ones."""
    found = pc.index_in(column, value_set=pa.array(codes, pa.string()).cast(column.type))
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)


def predictor(codes: Sequence[Sequence[str]], weights: Sequence[Sequence[float]], intercept: float) -> Callable[..., Column]:
    """A function of the code columns: the sum of their codes' weights and the intercept, null where one is unknown."""
    weights = [np.asarray(w, np.float64) for w in weights]

    def predict(*columns: pa.Array) -> pa.Array:
        total, unknown = np.zeros(len(columns[0])), np.zeros(len(columns[0]), bool)
        for column, labels, weight in zip(columns, codes, weights):
            at = _places(column, labels)
            unknown |= at < 0
            total += weight[at] if len(weight) else 0.0
        return pa.array(total + intercept, mask=unknown)

    # Spark would otherwise compute it once for a filter on it and again for its value.
    return F.arrow_udf(predict, "double").asNondeterministic()


def code_moments(
    claims: DataFrame, columns: Sequence[str], codes: Sequence[Sequence[str]], features: Sequence[Sequence[int]], label: str = "label"
) -> DataFrame:
    """``a, b, n, labels, squares``: claims on which two features are both set, ``a <= b``, and their labels' sums.

    ``features``: the feature of each of ``codes``, -1 for none. Feature -1 of a result is set on every
    claim whose codes are all known; ``squares`` is of its row only. Claims without a label are
    left out. A task counts its claims and passes on at most a row per pair of features.
    """
    features = [np.asarray(f, np.int64) for f in features]
    sizes, k = [len(c) for c in codes], len(codes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {(p, q): np.zeros(sizes[p] * sizes[q], np.int64) for p in range(k) for q in range(p, k)}
        sums = {pair: np.zeros(len(cells)) for pair, cells in counts.items()}
        total, waiting = np.zeros(3), []

        def count() -> None:
            at, value = [np.concatenate(x) for x in zip(*(w[0] for w in waiting))], np.concatenate([w[1] for w in waiting])
            total[:] += len(value), value.sum(), value @ value
            for (p, q), cells in counts.items():
                cell = at[p] * sizes[q] + at[q]
                cells += np.bincount(cell, minlength=len(cells))
                sums[p, q] += np.bincount(cell, value, minlength=len(cells))
            waiting.clear()

        for batch in batches:
            at = [_places(batch.column(p), codes[p]).astype(np.int64) for p in range(k)]
            known = reduce(np.logical_and, [x >= 0 for x in at])
            if known.any():
                waiting.append(([x[known] for x in at], batch.column(k).to_numpy(zero_copy_only=False)[known]))
            if sum(len(w[1]) for w in waiting) >= _ROWS:
                count()
        if waiting:
            count()
        if not total[0]:
            return
        rows = [(np.array([-1]), np.array([-1]), np.array([int(total[0])]), total[1:2])]
        for (p, q), cells in counts.items():
            some = np.flatnonzero(cells)
            a, b = features[p][some // sizes[q]], features[q][some % sizes[q]]
            both = (a >= 0) & (b >= 0)
            a, b, n, labels = a[both], b[both], cells[some][both], sums[p, q][some][both]
            rows.append((np.minimum(a, b), np.maximum(a, b), n, labels))
            if p == q:
                rows.append((np.full(len(b), -1), b, n, labels))
        a, b, n, labels = (np.concatenate(x) for x in zip(*rows))
        squares = np.where(np.arange(len(a)) == 0, total[2], 0.0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                pa.array(n.astype(np.int64)), pa.array(labels), pa.array(squares),
            ],
            names=["a", "b", "n", "labels", "squares"],
        )

    rows = claims.where(F.col(label).isNotNull()).select(*columns, F.col(label).cast("double").alias("_label"))
    return rows.mapInArrow(work, _MOMENTS).groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.sum("labels").alias("labels"), F.sum("squares").alias("squares")
    )
