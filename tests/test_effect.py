"""Residual statistics, the guard and Welch's test on hand-made tables."""

import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators import audit, effect

SCHEMA = (
    "clm_blg_prvdr_npi_num bigint, clm_src_type string, period string,"
    " clm_sbmt_chrg_amt double, prediction double, scored boolean"
)
STATS = (
    "clm_blg_prvdr_npi_num bigint, avg_incorrect_before double, stdev_incorrect_before double,"
    " sample_size_before bigint, avg_incorrect_after double, stdev_incorrect_after double,"
    " sample_size_after bigint"
)


def claims(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_decimal_charge_minus_double_prediction_is_double(spark):
    df = spark.sql(
        "SELECT 1L AS clm_blg_prvdr_npi_num, 'B' AS clm_src_type, 'before' AS period,"
        " cast(10.50 AS decimal(18,2)) AS clm_sbmt_chrg_amt, 4.25D AS prediction"
    )
    out = effect.residuals(df)
    assert dict(out.dtypes)["incorrect_billing_amt"] == "double"
    assert out.first()["incorrect_billing_amt"] == 6.25


def test_before_after_matches_plain_python(spark):
    before, after = [3.0, 5.0, 10.0], [1.0, 1.5, 4.0, 2.0]
    rows = [(1, "A", "before", x, 1.0, True) for x in before]
    rows += [(1, "B", "after", x, 0.5, True) for x in after]
    rows += [(2, "A", "before", 1.0, 1.0, True)]  # nothing after: left out
    rows += [(None, "A", p, 1.0, 1.0, True) for p in fixed.PERIODS]  # no provider: left out
    (row,) = effect.before_after(claims(spark, rows)).collect()
    assert row["avg_incorrect_before"] == pytest.approx(statistics.mean(before) - 1)
    assert row["stdev_incorrect_before"] == pytest.approx(statistics.stdev(before))
    assert row["avg_incorrect_after"] == pytest.approx(statistics.mean(after) - 0.5)
    assert row["stdev_incorrect_after"] == pytest.approx(statistics.stdev(after))
    assert (row["sample_size_before"], row["sample_size_after"]) == (3, 4)


def test_missing_amounts_do_not_count(spark):
    rows = [(1, "A", p, x, 0.0, True) for p in fixed.PERIODS for x in (1.0, 2.0, None)]
    (row,) = effect.before_after(claims(spark, rows)).collect()
    assert (row["sample_size_before"], row["sample_size_after"]) == (2, 2)


def test_profile_equals_separate_aggregates(spark):
    rows = [
        (k, t, p, float(k + i), 0.5 * i, (i + k) % 4 != 0)
        for k in range(1, 4)
        for t in fixed.CLAIM_TYPES
        for p in fixed.PERIODS
        for i in range(6)
    ]
    df = claims(spark, rows)
    profile = effect.provider_profile(df, F.col("scored"))
    frames = effect.provider_profile(df.drop("scored"), df.where("scored"))
    want = sorted(effect.before_after(df.where("scored")).collect())
    for got in (sorted(effect.profile_stats(p).collect()) for p in (profile, frames)):
        for mine, theirs in zip(got, want, strict=True):
            assert mine == pytest.approx(theirs)
    counts = sorted(audit.claim_counts(df, F.col("scored")).collect())
    two_frames = sorted(audit.claim_counts(df, df.where("scored")).collect())
    assert counts == two_frames
    from_profile = audit.profile_counts(profile).where("before > 0")
    assert sorted(map(tuple, from_profile.collect())) == sorted(map(tuple, counts))


@pytest.mark.parametrize(
    "n1, n2, s1, s2, kept",
    [
        (50, 50, 1.0, 1.0, True),
        (49, 50, 1.0, 1.0, False),
        (50, 49, 1.0, 1.0, False),
        (80, 80, 0.0, 1.0, False),
        (80, 80, 1.0, 0.0, False),
        (80, 80, None, 1.0, False),
    ],
)
def test_guard(spark, n1, n2, s1, s2, kept):
    df = spark.createDataFrame([(1, 0.0, s1, n1, 1.0, s2, n2)], STATS)
    assert effect.testable(df).count() == int(kept)


def test_ten_digit_provider_ids_survive(spark):
    df = spark.createDataFrame([(9_876_543_210, 0.0, 1.0, 60, 1.0, 1.0, 60)], STATS)
    as_text = df.withColumn(fixed.PROVIDER, F.col(fixed.PROVIDER).cast("string"))
    assert effect.testable(as_text).first()[fixed.PROVIDER] == 9_876_543_210


def test_test_statistic_by_hand(spark):
    df = spark.createDataFrame([(7, 10.0, 2.0, 60, 9.0, 3.0, 80)], STATS)
    row = effect.welch_test(df).first()
    v1, v2 = 4 / 60, 9 / 80
    assert row["average_difference"] == -1.0  # after minus before
    assert row["t_value"] == pytest.approx(1 / math.sqrt(v1 + v2))  # before minus after
    assert row["dof"] == pytest.approx((v1 + v2) ** 2 / (v1**2 / 59 + v2**2 / 79))


def test_flag_follows_p_and_direction(spark):
    rows = [
        (1, 0.0, 1.0, 60, -5.0, 1.0, 60),  # clearly lower
        (2, 0.0, 1.0, 60, 5.0, 1.0, 60),  # clearly higher
        (3, 0.0, 1.0, 60, 0.01, 1.0, 60),  # no difference
    ]
    df = spark.createDataFrame(rows, STATS)

    def flags(**kwargs):
        return {r["provider_id"]: r["flag"] for r in effect.welch_test(df, **kwargs).collect()}

    assert flags() == {1: "N", 2: "N", 3: "Y"}
    assert flags(direction="improved") == {1: "N", 2: "Y", 3: "Y"}
    with pytest.raises(ValueError):
        flags(direction="sideways")


def test_samples_without_spread_or_size(spark):
    rows = [
        (1, 1.0, 0.0, 60, 2.0, 0.0, 60),  # t infinite: p is 0
        (2, 1.0, 0.0, 60, 1.0, 0.0, 60),  # 0/0: p is NaN, flag Y
        (3, 1.0, None, 1, 2.0, 1.0, 60),  # no deviation: p is null, flag Y
    ]
    got = {r["provider_id"]: r for r in effect.welch_test(spark.createDataFrame(rows, STATS)).collect()}
    assert (got[1]["p_value"], got[1]["flag"]) == (0.0, "N")
    assert math.isnan(got[2]["p_value"]) and got[2]["flag"] == "Y"
    assert got[3]["p_value"] is None and got[3]["flag"] == "Y"


SIDE = st.tuples(
    st.floats(-1e4, 1e4), st.floats(0.01, 1e4), st.integers(min_value=50, max_value=10**7)
)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(SIDE, SIDE), min_size=1, max_size=20))
def test_swapping_periods_turns_t_around(spark, pairs):
    forward = [(i, *a, *b) for i, (a, b) in enumerate(pairs)]
    backward = [(i, *b, *a) for i, (a, b) in enumerate(pairs)]
    one, two = (
        {r["provider_id"]: r for r in effect.welch_test(spark.createDataFrame(x, STATS)).collect()}
        for x in (forward, backward)
    )
    for i in one:
        assert one[i]["t_value"] == pytest.approx(-two[i]["t_value"])
        assert one[i]["p_value"] == pytest.approx(two[i]["p_value"], rel=1e-9, abs=1e-300)
        assert 0 <= one[i]["p_value"] <= 1


def test_audit_reports_and_strict_hides_fully_skipped(spark):
    rows = [(1, "A", "before", 1.0, 1.0, s) for s in (True, False)]
    rows += [(2, "A", "before", 1.0, 1.0, False)] * 2
    rows += [(3, "A", "before", 1.0, 1.0, True)]
    df = claims(spark, rows)
    counts = audit.claim_counts(df, df.where("scored"))

    def result(strict):
        out = audit.skipped_claims(counts, "2001-12-31", strict).collect()
        return sorted((r[fixed.PROVIDER], r["before"], r["after"]) for r in out)

    assert result(strict=False) == [(1, 2, 1), (2, 2, 0)]
    assert result(strict=True) == [(1, 2, 1)]


def test_published_form(spark):
    df = spark.createDataFrame([(9_876_543_210, 0.0, 1.0, 60, 1.0, 1.0, 60)], STATS)
    out = effect.as_published(effect.test_results(df))
    assert out.columns == ["Educated_NPI", "Averge_Difference", "Test_Value", "P_value", "Flag"]
    assert [t for _, t in out.dtypes] == ["bigint", "float", "float", "float", "string"]


def test_profile_counts_other_types_and_claims_without_provider(spark):
    rows = spark.createDataFrame(
        [(1, "B", "before", True), (1, "X", "before", False), (1, None, "after", False), (None, "A", "after", False)],
        "clm_blg_prvdr_npi_num long, clm_src_type string, period string, scored boolean",
    ).select("*", F.lit(1.0).alias("clm_sbmt_chrg_amt"), F.lit(1.0).alias("prediction"))
    profile = effect.provider_profile(rows, F.col("scored"))
    counts = audit.profile_counts(profile).where("before > 0")
    assert {tuple(r) for r in counts.collect()} == {
        (1, "B", "before", 1, 1), (1, "other", "before", 1, 0), (1, "other", "after", 1, 0), (None, "A", "after", 1, 0),
    }
    skipped = audit.skipped_claims(audit.claim_counts(rows, F.col("scored")), "2001-12-31")
    assert {(r[0], r[1]) for r in skipped.collect()} == {(1, "X"), (1, None), (None, "A")}
    assert audit.skipped_claims(counts, "2001-12-31", strict=True).isEmpty()
    assert effect.profile_stats(profile).isEmpty()
