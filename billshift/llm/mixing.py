"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is taken ``target / source size`` times on average: the
whole part of that ratio for certain, the rest with an inclusion probability. The
cube method draws the rest so that, in every source, both the number of words and
the number of documents taken come out as expected. Its flight phase moves the
probabilities within the null space of these two constraints until at most two
of a block remain fractional; blocks of bounded size run side by side, what they
leave runs again in blocks, and the last few of a source are landed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billshift.functions.names import unused
from billshift.sources.writers import materialise

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A document is taken at most so many times.
MAX_REPEATS = 3
#: Most documents of a block of the flight phase.
BLOCK = 4096
#: Units that the flight leaves for the landing, beside the two it cannot fix. The
#: landing weighs all ``2 ** (LANDING + 2)`` outcomes of the last units of a source.
LANDING = 12
_NEAR = 1e-9


def word_count(text: Column) -> Column:
    """Words of ASCII white space separation; none for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_REPEATS
) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Targets share the sum of all sizes by weight; none is above ``most`` times its
    source's size, the excess goes to the others by weight. That is
    ``min(most * size, level * weight)`` with one level for all. One row per source
    is what the windows here see, never the documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    cap = F.col("source_size") * float(most)
    rows = totals.withColumn("weight", weight).withColumn("cap", cap)
    # Sources in the order in which a rising level meets their caps.
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    below = rising.rowsBetween(Window.unboundedPreceding, -1)
    above = rising.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "total": F.sum("source_size").over(Window.partitionBy()),
            "capped": F.coalesce(F.sum("cap").over(below), F.lit(0.0)),
            "open": F.sum("weight").over(above),
        }
    )
    level = (F.col("total") - F.col("capped")) / F.col("open")
    # Closing capped sources raises the level, closing one that is below its cap lowers
    # it: the level that holds is the highest.
    rows = rows.withColumn("level", F.max(level).over(Window.partitionBy()))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", "n", target.alias("target"))


def flight(p: np.ndarray, x: np.ndarray, spare: int = LANDING) -> np.ndarray:
    """Move probabilities ``p`` to 0 or 1, keeping ``p @ x``, while three are fractional.

    The last ``spare`` units stay as they are.

    With two constraints any three fractional units have a direction in the null
    space; going along it to the cube's face fixes at least one of them. Of the two
    ends the nearer is taken with the larger chance (the martingale rule), drawn from
    a generator seeded by the block's data.
    """
    p = p.astype(float).copy()
    rng = np.random.default_rng([len(p), int(abs(x.sum())) % (1 << 62)])
    draws = rng.random(3 * len(p) + 8)
    used = 0
    live = [i for i in range(len(p)) if _NEAR < p[i] < 1 - _NEAR]
    live = live[: max(0, len(live) - spare)]
    waiting, hand = live[3:][::-1], live[:3]
    while len(hand) == 3:
        (a1, b1), (a2, b2), (a3, b3) = x[hand[0]], x[hand[1]], x[hand[2]]
        u = np.array([a2 * b3 - a3 * b2, a3 * b1 - a1 * b3, a1 * b2 - a2 * b1])
        if not u.any():  # the three are alike: any direction within sum zero does
            u = np.array([1.0, -1.0, 0.0])
        u = u / abs(u).max()
        now = p[hand]
        up = min((1 - v) / d if d > 0 else -v / d for v, d in zip(now, u) if d)
        down = min(v / d if d > 0 else (v - 1) / d for v, d in zip(now, u) if d)
        step = up if draws[used] * (up + down) < down else -down
        used += 1
        p[hand] = now + step * u
        hand_next = []
        for i in hand:
            if p[i] <= _NEAR or p[i] >= 1 - _NEAR:
                p[i] = round(p[i])
            else:
                hand_next.append(i)
        hand = hand_next
        while len(hand) < 3 and waiting:
            hand.append(waiting.pop())
    return p


def _fly(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["draw", "doc_id", "size", "text_hash"], kind="stable")
    x = np.column_stack([block["size"].to_numpy(float), block["n"].to_numpy(float)])
    return block.assign(p=flight(block["p"].to_numpy(), x))


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The outcome of a few units whose words, and then number, are nearest to expected."""
    masks = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    words = abs(masks @ size - p @ size)
    number = abs(masks.sum(axis=1) - p.sum())
    return masks[np.lexsort((number, words))[0]].astype(float)


def _land(block: pd.DataFrame) -> pd.DataFrame:
    block = _fly(block)
    p = block["p"].to_numpy().copy()
    last = np.flatnonzero((p > _NEAR) & (p < 1 - _NEAR))
    p[last] = landing(p[last], block["size"].to_numpy(float)[last])
    return block.assign(p=p)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MAX_REPEATS,
    block: int = BLOCK,
) -> DataFrame:
    """How often every document is taken: ``doc_id, source, text_hash, n, size,
    source_size, target, times``.

    Rows with the same doc_id, source and text are one unit of ``n`` rows, all taken
    equally often; ``size`` is the unit's words. Null texts have size 0, null sources
    come last. Drawing depends on the data alone, so reruns agree.
    """
    rows = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size")
    )
    units = rows.groupBy("doc_id", "source", "text_hash").agg(
        F.sum("size").alias("size"), F.count("*").alias("n")
    )
    units = materialise(units, "mix-units")
    targets = source_targets(units, weights, most)
    targets = materialise(targets, "mix-targets")
    same = units["source"].eqNullSafe(targets["source"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = F.xxhash64(F.col("doc_id"), F.col("text_hash"))
    # A block is a part of one source: a source with a third of all rows has many.
    placed = units.join(targets.withColumnRenamed("n", "units"), same).select(
        # As text: pandas would turn ids beside a null into floats.
        units["doc_id"].cast("string").alias("doc_id"), units["source"], "text_hash", units["size"], units["n"], "source_size", "target",
        F.least(F.floor(ratio + _NEAR), F.lit(most)).cast("long").alias("whole"),
        ratio.alias("ratio"), draw.alias("draw"),
        F.pmod(draw, F.ceil(F.col("units") * 2 / block)).alias("part"),
    )
    placed = placed.withColumn("p", F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0))).drop("ratio")
    schema = placed.schema
    open_ = (F.col("p") > _NEAR) & (F.col("p") < 1 - _NEAR)
    flown = materialise(placed.groupBy("source", "part").applyInPandas(_fly, schema), "mix-flown")
    settled, left = [flown.where(~open_)], flown.where(open_)
    while True:
        most_left = left.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if most_left <= block:
            break
        parts = F.pmod(F.col("draw"), F.lit(-(-2 * most_left // block)))
        again = left.withColumn("part", parts).groupBy("source", "part").applyInPandas(_fly, schema)
        again = materialise(again, "mix-flown")
        settled.append(again.where(~open_))
        left = again.where(open_)
    settled.append(left.groupBy("source").applyInPandas(_land, schema))
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    return done.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "text_hash", "n", "size", "source_size", "target",
        (F.col("whole") + F.round("p").cast("long")).alias("times"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    names = docs.columns
    # Helper columns under names that the table has not.
    own, doc_id, source, text_hash, times, copy = (
        unused(names, n) for n in ("_text_hash", "_id", "_source", "_hash", "_times", "_copy")
    )
    taken = mix(docs).where("times > 0").select(
        F.col("doc_id").alias(doc_id), F.col("source").alias(source), F.col("text_hash").alias(text_hash), F.col("times").alias(times)
    )
    rows = docs.withColumn(own, F.xxhash64("text"))
    same = (
        rows["doc_id"].eqNullSafe(taken[doc_id])
        & rows["source"].eqNullSafe(taken[source])
        & (rows[own] == taken[text_hash])
    )
    repeated = rows.join(taken.hint("merge"), same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
    return repeated.select(*names)
