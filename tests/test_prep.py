"""Cleaning and projecting claims."""

import pytest

from billshift import fixed
from billshift.operators import prep


def claim_table(spark, n_types=1):
    codes = [*fixed.code_columns("B"), *fixed.NUMBERED_PROCEDURES]
    columns = ", ".join(f"'' AS {c}" if i % 3 == 0 else f"'x{i}' AS {c}" for i, c in enumerate(codes))
    return spark.sql(
        f"""SELECT 4000000001L AS clm_blg_prvdr_npi_num, kind AS clm_src_type,
                   date '2000-01-01' AS clm_line_from_dt, date '2000-06-01' AS current_education_date,
                   cast(12.5 AS decimal(18,2)) AS clm_sbmt_chrg_amt, 'unused' AS remark, {columns}
            FROM (SELECT explode(array('A', 'B', 'DME')) AS kind)"""
    )


def test_only_empty_strings_become_the_token(spark):
    df = spark.createDataFrame([("", " ", None, 0)], "a string, b string, c string, d int")
    assert tuple(prep.blank_to_token(df).first()) == ("EMPTY", " ", None, 0)


@pytest.mark.parametrize("kind, n", [("A", 20), ("B", 14), ("DME", 14)])
def test_scoring_columns(kind, n):
    columns = prep.scoring_columns(kind)
    assert len(columns) == len(set(columns)) == n
    assert set(fixed.code_columns(kind)) <= set(columns)


def test_code_columns():
    assert len(fixed.code_columns("A")) == 15 and len(fixed.code_columns("B")) == 11
    assert fixed.PROCEDURE not in fixed.code_columns("A")
    with pytest.raises(ValueError):
        fixed.code_columns("C")


def test_scoring_frame_keeps_both_periods_and_upper_names(spark):
    table = claim_table(spark)
    frame = prep.prepare_scoring(prep.with_periods(table, table), "B")
    assert all(c == c.upper() for c in frame.columns)
    assert sorted(r["PERIOD"] for r in frame.collect()) == ["after", "before"]
    assert {r["STATE_CD"] for r in frame.collect()} == {"EMPTY"}


def test_type_a_may_come_without_a_type_column(spark):
    table = claim_table(spark).where("clm_src_type = 'A'").drop("clm_src_type")
    frame = prep.prepare_scoring(prep.with_periods(table, table), "A")
    assert {r["CLM_SRC_TYPE"] for r in frame.collect()} == {"A"}
    assert prep.prepare_training(table, "A").count() == 1


def test_training_frame_has_label_and_codes_only(spark):
    frame = prep.prepare_training(claim_table(spark), "DME")
    assert frame.columns == [c.upper() for c in fixed.code_columns("DME")] + ["label"]
    assert frame.count() == 1


def test_type_filter_and_columns_reach_the_stored_claims(spark, tmp_path):
    path = str(tmp_path / "claims")
    claim_table(spark).write.parquet(path)
    stored = spark.read.parquet(path)
    frame = prep.prepare_scoring(prep.with_periods(stored, stored), "B").select("CLM_SBMT_CHRG_AMT")
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert text.count("EqualTo(clm_src_type,B)") == 2  # before and after
    assert "remark" not in text and "state_cd" not in text
