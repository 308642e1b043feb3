"""Residuals before and after education, and the test of their difference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billshift import fixed
from billshift.functions.ids import as_id
from billshift.functions.student_t import t_two_sided


def residual() -> Column:
    return F.col(fixed.AMOUNT) - F.col("prediction")


def residuals(scored: DataFrame) -> DataFrame:
    """Charge minus expected charge per claim."""
    return scored.select(
        fixed.PROVIDER,
        fixed.CLAIM_TYPE,
        "period",
        fixed.AMOUNT,
        "prediction",
        residual().alias("incorrect_billing_amt"),
    )


def _period_stats(usable: Column) -> list[Column]:
    stats = []
    for period in fixed.PERIODS:
        here = usable & (F.col("period") == period)
        stats += [
            F.avg(F.when(here, residual())).alias(f"avg_incorrect_{period}"),
            F.stddev_samp(F.when(here, residual())).alias(f"stdev_incorrect_{period}"),
            F.count(F.when(here, F.col(fixed.AMOUNT))).alias(f"sample_size_{period}"),
            F.count_if(here).alias(f"scored_{period}"),
        ]
    return stats


def _both_periods(stats: DataFrame) -> DataFrame:
    """Providers with scored claims on both sides."""
    return stats.where((F.col("scored_before") > 0) & (F.col("scored_after") > 0)).select(
        fixed.PROVIDER,
        *[
            f"{name}_{period}"
            for period in fixed.PERIODS
            for name in ("avg_incorrect", "stdev_incorrect", "sample_size")
        ],
    )


def before_after(scored: DataFrame) -> DataFrame:
    """Mean, sample deviation and claim count of both periods per provider.

    Both periods come from one conditional aggregate, so there is a single scan, a
    single shuffle of one partial row per provider and task, and no join.
    """
    known = scored.where(F.col(fixed.PROVIDER).isNotNull())
    return _both_periods(known.groupBy(fixed.PROVIDER).agg(*_period_stats(F.lit(True))))


def residual_stats(scored: DataFrame) -> DataFrame:
    """The same statistics in long form: one row per provider and period."""
    return scored.groupBy(fixed.PROVIDER, "period").agg(
        F.avg(residual()).alias("avg_incorrect"),
        F.stddev_samp(residual()).alias("stdev_incorrect"),
        F.count(fixed.AMOUNT).alias("sample_size"),
    )


def provider_profile(
    raw: DataFrame, scored: DataFrame | Column, types: Sequence[str] = tuple(fixed.CLAIM_TYPES)
) -> DataFrame:
    """Statistics and raw/scored claim counts per provider from one grouping.

    ``scored`` is the frame of scored claims, or a boolean column of ``raw``. The
    result, one row per provider, feeds both the effect test and the audit, so
    claims are scored once. Claims of other or no type are counted under ``other``,
    claims without a provider in a row of their own.
    """
    keys = [fixed.PROVIDER, fixed.CLAIM_TYPE, "period"]
    measures = [fixed.AMOUNT, "prediction"]
    if isinstance(scored, Column):
        rows = raw.select(
            *keys, *measures, F.lit(True).alias("is_raw"), scored.alias("is_scored")
        )
    else:
        predicted = scored.select(
            *keys,
            *[F.col(m).cast("double").alias(m) for m in measures],
            F.lit(False).alias("is_raw"),
            F.lit(True).alias("is_scored"),
        )
        rows = predicted.unionByName(
            raw.select(
                *keys,
                *[F.lit(None).cast("double").alias(m) for m in measures],
                F.lit(True).alias("is_raw"),
                F.lit(False).alias("is_scored"),
            )
        )
    counts = []
    cells = {kind: F.col(fixed.CLAIM_TYPE) == kind for kind in types}
    cells[fixed.OTHER_TYPE] = ~F.coalesce(F.col(fixed.CLAIM_TYPE).isin(*types), F.lit(False))
    for kind, of_kind in cells.items():
        for period in fixed.PERIODS:
            here = of_kind & (F.col("period") == period)
            counts += [
                F.count_if(here & F.col("is_raw")).alias(f"raw_{kind}_{period}"),
                F.count_if(here & F.col("is_scored")).alias(f"scored_{kind}_{period}"),
            ]
    return rows.groupBy(fixed.PROVIDER).agg(*_period_stats(F.col("is_scored")), *counts)


def profile_stats(profile: DataFrame) -> DataFrame:
    """``before_after`` from a provider profile."""
    return _both_periods(profile.where(F.col(fixed.PROVIDER).isNotNull()))


def testable(stats: DataFrame, min_n: int = fixed.MIN_CLAIMS) -> DataFrame:
    """Providers with enough claims and some spread on both sides, 64-bit ids."""
    condition = F.lit(True)
    for period in fixed.PERIODS:
        condition = (
            condition
            & (F.col(f"sample_size_{period}") >= min_n)
            & (F.col(f"stdev_incorrect_{period}") > 0)
        )
    return stats.where(condition).withColumn(fixed.PROVIDER, as_id(fixed.PROVIDER))


testable.__test__ = False  # not a pytest function


def welch(
    mean1: Column, sd1: Column, n1: Column, mean2: Column, sd2: Column, n2: Column
) -> tuple[Column, Column]:
    """t (first minus second mean) and Welch-Satterthwaite degrees of freedom.

    Two samples without spread give t = +-inf, or NaN for equal means; the degrees
    of freedom are then 1. A sample of fewer than two gives null.
    """
    v1 = F.try_divide(sd1 * sd1, n1)
    v2 = F.try_divide(sd2 * sd2, n2)
    diff = mean1 - mean2
    spread = F.sqrt(v1 + v2)
    unlimited = (
        F.when(diff > 0, float("inf")).when(diff < 0, float("-inf")).otherwise(float("nan"))
    )
    t = F.when(spread > 0, F.try_divide(diff, spread)).when(spread == 0, unlimited)
    dof = F.when(
        spread > 0,
        F.try_divide(
            (v1 + v2) * (v1 + v2),
            F.try_divide(v1 * v1, n1 - 1) + F.try_divide(v2 * v2, n2 - 1),
        ),
    ).when(spread == 0, F.lit(1.0))
    return t, dof


def welch_test(
    stats: DataFrame, alpha: float = fixed.ALPHA, direction: str = "two-sided"
) -> DataFrame:
    """Welch's unequal-variance t-test per provider, with the resulting flag.

    ``N`` where p < alpha, otherwise ``Y``. By default a significant worsening
    counts too; ``direction="improved"`` asks for a lower mean after education.
    """
    if direction not in ("two-sided", "improved"):
        raise ValueError(f"unknown direction {direction!r}")
    sides = [
        F.col(f"{name}_{period}")
        for period in fixed.PERIODS
        for name in ("avg_incorrect", "stdev_incorrect", "sample_size")
    ]
    t, dof = welch(*sides)
    difference = F.col("avg_incorrect_after") - F.col("avg_incorrect_before")
    tested = stats.select(
        F.col(fixed.PROVIDER).alias("provider_id"),
        difference.alias("average_difference"),
        t.alias("t_value"),
        dof.alias("dof"),
    ).withColumn("p_value", t_two_sided(F.col("t_value"), F.col("dof")))
    effective = F.col("p_value") < alpha
    if direction == "improved":
        effective = effective & (F.col("average_difference") < 0)
    flag = F.when(effective, fixed.FLAG_EFFECTIVE).otherwise(fixed.FLAG_NOT_EFFECTIVE)
    return tested.withColumn("flag", flag)


def test_results(stats: DataFrame, alpha: float = fixed.ALPHA, direction: str = "two-sided") -> DataFrame:
    """Guard, test and result row: provider, difference, t, p, flag."""
    return welch_test(testable(stats), alpha, direction).select(
        "provider_id", "average_difference", "t_value", "p_value", "flag"
    )


test_results.__test__ = False  # not a pytest function


def as_published(results: DataFrame) -> DataFrame:
    """Results under the names and 32-bit measures older tables use; ids stay 64-bit."""
    narrow = results.withColumns(
        {c: F.col(c).cast("float") for c in ("average_difference", "t_value", "p_value")}
    )
    return narrow.select(*[F.col(c).alias(n) for c, n in fixed.PUBLISHED_RESULT.items()])
