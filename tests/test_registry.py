"""Every registered query against its SQL."""

import pytest
from compare import normalised, spark_rows, sql_rows

from __spark_entry__ import entry
from billshift.registry.oracle import ORACLE
from billshift.registry.queries import QUERIES

WITHOUT_SQL = {"ml_evaluation", "ml_train_score"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, sf_dir, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    want = normalised(*sql_rows(sf_dir, ORACLE[name]))
    assert got[0] == want[0]
    assert got[1] == want[1]
    # At this scale every N report has a new model; the larger check covers the rest.
    assert got[1] or name == "unchanged_reports"


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


def test_entry_flags_every_report(spark, sf_dir):
    df = entry(spark)
    assert df.columns == ["asrpt_id", "run_date", "report_flag"]
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").count()
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    assert df.count() == suppliers + customers
