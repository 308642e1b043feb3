"""The lasso regression solved to its optimum, from counts of codes that occur together.

Spark ML's solver stops near the optimum, and how near depends on the data. Features are
codes, so all the loss needs to know are integer counts: claims per pair of codes, and charges
per code. One grouping finds them; what remains is as large as the model squared and solved
on the driver, as Spark ML's own normal equations are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StructField, StructType

from billshift import fixed
from billshift.operators.coded import code_moments
from billshift.operators.weights import INTERCEPT, SCHEMA

#: Features whose pairs the driver holds at most; Spark ML's normal equations have the same limit.
MOST_FEATURES = 4096


def code_pairs(claims: DataFrame, weights: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """``a, b, n, labels``: claims on which two features are both set, ``a <= b``, and their labels' sum.

    Feature -1 is set on every claim the model can score. Counted per task before the shuffle:
    at most the square of the number of features, however many claims there are.
    """
    codes: list[list[str]] = [[] for _ in columns]
    features: list[list[int]] = [[] for _ in columns]
    for position, code, feature in weights.select("position", "code", "feature").collect():
        if position != INTERCEPT and code is not None:
            codes[position].append(code)
            features[position].append(-1 if feature is None else feature)
    return code_moments(claims, columns, codes, features, label).select("a", "b", "n", "labels")


def moment_rows(spark: SparkSession, moments: DataFrame, size: int) -> DataFrame | None:
    """As many rows of ``features, label`` as there are features, with the claims' means and covariances.

    The least squares of the claims, penalised or not, is the one of these rows: the normal
    equations hold nothing but these moments. ``moments`` as from ``code_moments``; None without claims.
    """
    count, labels, squares = np.zeros((size + 1, size + 1)), np.zeros(size + 1), 0.0
    for a, b, n, total, square in moments.collect():
        # Place 0 is the feature that every claim has.
        count[a + 1, b + 1] = count[b + 1, a + 1] = n
        if a == INTERCEPT:
            labels[b + 1] = total
            squares += square
    if not count[0, 0]:
        return None
    mean = np.append(count[0, 1:], labels[0]) / count[0, 0]
    spread = np.zeros((size + 1, size + 1))
    spread[:size, :size] = count[1:, 1:] / count[0, 0]
    spread[size] = spread[:, size] = np.append(labels[1:], squares) / count[0, 0]
    spread -= np.outer(mean, mean)
    # What does not vary stays exactly at its mean.
    vary = np.flatnonzero(np.diag(spread) > 0)
    scale = np.sqrt(np.diag(spread)[vary])
    power, axes = np.linalg.eigh(spread[np.ix_(vary, vary)] / np.outer(scale, scale))
    root = scale[:, None] * axes * np.sqrt(power.clip(0))
    # Helmert's contrasts: orthogonal to each other and to the mean.
    k = len(vary)
    low = np.arange(1, k + 1)
    contrasts = np.where(np.arange(k + 1)[:, None] < low, 1.0, 0.0) / np.sqrt(low * (low + 1.0))
    contrasts[low, low - 1] = -np.sqrt(low / (low + 1.0))
    rows = np.tile(mean, (k + 1, 1))
    rows[:, vary] += np.sqrt(k + 1) * contrasts @ root.T
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())])
    return spark.createDataFrame([(Vectors.dense(row[:size]), float(row[size])) for row in rows], schema)


def feature_signs(
    spread: np.ndarray, along: np.ndarray, penalty: np.ndarray, start: np.ndarray, most: int = 10_000
) -> np.ndarray:
    """Minimise ``w'Sw / 2 - c'w + sum(penalty * |w|)`` by feature-sign search (Lee et al., 2007).

    With the signs of the weights known the problem is linear. Each step solves it for the signs
    at hand, moves towards the solution as far as the objective falls (a weight that crosses
    zero is set to it), and lets in the feature that breaks its condition most. Of features
    that depend on each other the shortest step is taken.
    """
    w = start.astype(float).copy()
    close = 1e-10 * float(abs(along).max(initial=0.0))
    for _ in range(most):
        slope, sign = along - spread @ w, np.sign(w)
        active = w != 0
        if (abs(slope - penalty * sign) <= close)[active].all():
            excess = np.where(active | (np.diag(spread) <= 0), 0.0, abs(slope) - penalty)
            entering = int(excess.argmax()) if len(w) else 0
            if not len(w) or excess[entering] <= close:
                break
            sign[entering] = np.sign(slope[entering])
            active[entering] = True
        on = np.flatnonzero(active)
        step = np.zeros(len(w))
        size, axes = np.linalg.eigh(spread[np.ix_(on, on)])
        flat = size <= 1e-10 * size[-1]
        # Where features depend on each other the loss is flat, and only the penalty changes: that
        # direction comes first, and it ends where a weight becomes zero.
        rest = axes[:, flat] @ (axes[:, flat].T @ (penalty * sign)[on])
        free = abs(rest).max() > 1e-6 * penalty.max()
        if free:
            step[on], curve, fall = -rest, 0.0, 0.0
        else:
            steep = axes[:, ~flat]
            step[on] = steep @ ((steep.T @ (slope - penalty * sign)[on]) / size[~flat])
            curve, fall = step @ spread @ step, slope @ step
        with np.errstate(divide="ignore", invalid="ignore"):
            zeros = np.where((w != 0) & (step != 0), -w / step, np.inf)
        ends = zeros[(zeros > 0) & (zeros < (np.inf if free else 1.0))]
        stops = np.unique(ends if free and len(ends) else np.append(ends, 1.0))
        # By differences, as the objective itself is large.
        change = [t * t * curve / 2 - t * fall + penalty @ (abs(w + t * step) - abs(w)) for t in stops]
        best = int(np.argmin(change))
        if change[best] >= 0:
            break
        w = np.where(zeros == stops[best], 0.0, w + stops[best] * step)
    return w


def refine(
    claims: DataFrame, weights: DataFrame, columns: Sequence[str], penalty: float = fixed.REG_PARAM, label: str = "label"
) -> DataFrame:
    """The weights table of a fitted model (``weights.model_weights``) moved to the optimum.

    ``claims`` are those the model was fitted on. Only features of the model take part.
    """
    spark = claims.sparkSession
    table = weights.select("position", "code", "level", "feature", "weight").toArrow().to_pylist()
    features = sorted((r for r in table if r["feature"] is not None), key=lambda r: r["feature"])
    size = len(features)
    if size > MOST_FEATURES:
        raise ValueError(f"{size} features; their pairs are held up to {MOST_FEATURES}")
    count, labels = np.zeros((size + 1, size + 1)), np.zeros(size + 1)
    for a, b, n, total in code_pairs(claims, weights, columns, label).collect():
        # Place 0 is the feature that every claim has.
        count[a + 1, b + 1] = count[b + 1, a + 1] = n
        if a == INTERCEPT:
            labels[b + 1] = total
    claims_n = max(count[0, 0], 1.0)
    share, mean = count[0, 1:] / claims_n, labels[0] / claims_n
    spread = count[1:, 1:] / claims_n - np.outer(share, share)
    scale = np.sqrt(np.diag(spread).clip(0) * claims_n / max(claims_n - 1, 1))
    along = labels[1:] / claims_n - share * mean
    start = np.array([r["weight"] for r in features])
    # In units of each feature's deviation; a feature on all claims, or on none, weighs nothing.
    unit = np.divide(1.0, scale, out=np.zeros(size), where=scale > 0)
    solved = unit * feature_signs(
        spread * np.outer(unit, unit), along * unit, np.full(size, penalty), np.where(scale > 0, start * scale, 0.0)
    )
    for row, weight in zip(features, solved.tolist()):
        row["weight"] = weight
    for row in table:
        if row["position"] == INTERCEPT:
            row["weight"] = float(mean - share @ solved)
    return spark.createDataFrame([tuple(r.values()) for r in table], SCHEMA)
