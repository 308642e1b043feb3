"""Connected components of a link table, by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift.sources.writers import materialise


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links`` (``a, b``); ``label``: the smallest id reachable.

    Each round takes the smallest label among the neighbours and then that label's
    own label, so paths shorten by half and more. Labels are written out each round.
    Minima are taken per task before a shuffle: a hub with a third of all links is
    one row per task.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.where("a <> b").distinct(), "component-edges")
    labels = materialise(
        edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")),
        "component-labels",
    )
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "label").hint("merge"), "b")
        least = near.groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(least.withColumnRenamed("a", "id").hint("merge"), "id").select(
            "id", "label", F.least("label", "m").alias("next")
        )
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("far"))
        moved = materialise(
            step.join(jump.hint("merge"), "next").select(
                "id", F.least("next", "far").alias("label"), (F.least("next", "far") < F.col("label")).alias("changed")
            ),
            "component-labels",
        )
        labels = moved.select("id", "label")
        if moved.where("changed").limit(1).count() == 0:
            return labels
