"""A key with a third of all rows: same results, split instead of one long task."""

import re

import pytest
from pyspark.sql import functions as F

from billshift.operators import effect, reports

THIRD = 60_000


def hot_alerts(spark):
    """One report with a third of the alerts, the others with few each."""
    ids = spark.range(3 * THIRD).withColumn(
        "asrpt_id", F.when(F.col("id") < THIRD, 1).otherwise(2 + F.col("id") % 4000)
    )
    return ids.select(
        "asrpt_id",
        F.col("id").alias("alert_id"),
        (F.col("id") % 25).alias("model_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 401).cast("int")).alias("alert_creat_dt"),
        F.lit("2000-06-01").cast("date").alias("current_education_date"),
    )


def test_hot_report_is_one_row_per_model_before_the_shuffle(spark):
    flags = {r[0]: r[1] for r in reports.n_flags(hot_alerts(spark)).collect()}
    assert len(flags) == 4001 and flags[1] == "N"


@pytest.mark.parametrize("forced", ["true", "false"])
def test_hot_side_of_the_alert_join_is_split(spark, forced):
    """In a tuned session and in one that splits only where it costs no shuffle."""
    settings = {
        "spark.sql.adaptive.forceOptimizeSkewedJoin": forced,
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        alerts = hot_alerts(spark).repartition(8)
        flagged = spark.range(1, 4003).select(
            F.col("id").alias("asrpt_id"),
            F.lit("2000-06-01").cast("date").alias("current_education_date"),
            F.lit("N").alias("flag"),
            F.col("id").cast("string").alias("subj_id"),
        )
        models = spark.range(25).select(
            F.col("id").alias("model_id"), F.lit("Active").alias("model_actvty_stus")
        )
        found = reports.n_report_alerts(
            flagged,
            alerts.select("asrpt_id", "alert_id"),
            alerts.select("alert_id", "model_id", "alert_creat_dt"),
            models,
        )
        found.write.format("noop").mode("overwrite").save()
        assert found.count() == 3 * THIRD
        rows = found.groupBy("asrpt_id").count().where("asrpt_id = 1")
        assert rows.first()["count"] == THIRD
        found.collect()
        text = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin\(skew=true\)", text)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_hot_provider_statistics(spark):
    rows = spark.range(3 * THIRD).select(
        F.when(F.col("id") < THIRD, 1).otherwise(2 + F.col("id") % 500).alias("clm_blg_prvdr_npi_num"),
        F.lit("B").alias("clm_src_type"),
        F.when(F.col("id") % 2 == 0, "before").otherwise("after").alias("period"),
        (F.col("id") % 97).cast("double").alias("clm_sbmt_chrg_amt"),
        F.lit(1.0).alias("prediction"),
    )
    hot = effect.before_after(rows).where("clm_blg_prvdr_npi_num = 1").first()
    assert hot["sample_size_before"] + hot["sample_size_after"] == THIRD
