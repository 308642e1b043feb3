"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins against a hot key rely on adaptive execution splitting the hot
# partition, also where an aggregate on the same key follows the join.
# Broadcasts are left to Spark, which compares the side's size (from statistics,
# then from the finished shuffle stage) with autoBroadcastJoinThreshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder; cluster sizing stays with the caller."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
