"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from billshift.operators import effect, reports
from billshift.sources import star


FITTED = {"ml_evaluation", "ml_train_score", "scored_counts", "evaluations"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - FITTED))
def test_no_python_workers_and_no_pairing(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for operator in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "NestedLoop"):
        assert operator not in text


def test_profile_is_one_scan_and_one_shuffle(spark, sf_dir):
    df = effect.provider_profile(
        star.claims(spark, sf_dir).withColumn("prediction", F.lit(1.0)), F.col("scored")
    )
    text = plan(df)
    assert text.count("Scan parquet") == 1 and text.count("Exchange hashpartitioning") == 1


def test_type_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(star.claims(spark, sf_dir, "DME").select("clm_sbmt_chrg_amt"))
    assert "EqualTo(l_returnflag,R)" in text
    assert "l_linestatus" not in text and "l_orderkey" not in text


def test_counts_per_type_need_no_enrichment_join(spark, sf_dir):
    assert "Join" not in plan(queries()["claims_by_type"](spark, sf_dir))


def test_new_model_rule_needs_no_join(spark):
    df = spark.createDataFrame(
        [], "asrpt_id bigint, model_id bigint, alert_creat_dt date, current_education_date date"
    )
    assert "Join" not in plan(reports.n_flags(df))
