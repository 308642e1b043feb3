"""Claims the model could not score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billshift import fixed
from billshift.functions.dates import run_day

_KEYS = [fixed.PROVIDER, fixed.CLAIM_TYPE, "period"]


def claim_counts(raw: DataFrame, scored: DataFrame | Column) -> DataFrame:
    """Raw and scored claims per provider, type and period.

    ``scored`` is the frame of scored claims, or a boolean column of ``raw``, in
    which case there is only one scan. Either way one grouping counts both sides. Claims
    without a provider or type count under a null one.
    """
    if isinstance(scored, Column):
        rows = raw.select(*_KEYS, F.lit(1).alias("is_raw"), scored.cast("int").alias("is_scored"))
    else:
        rows = raw.select(*_KEYS, F.lit(1).alias("is_raw"), F.lit(0).alias("is_scored")).unionByName(
            scored.select(*_KEYS, F.lit(0).alias("is_raw"), F.lit(1).alias("is_scored"))
        )
    return rows.groupBy(*_KEYS).agg(F.sum("is_raw").alias("before"), F.sum("is_scored").alias("after"))


def profile_counts(profile: DataFrame, types: Sequence[str] = tuple(fixed.CLAIM_TYPES)) -> DataFrame:
    """``claim_counts`` read off a provider profile: its counters turned into rows.

    Claims of other types share one row per provider and period.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(kind).alias(fixed.CLAIM_TYPE),
                F.lit(period).alias("period"),
                F.col(f"raw_{kind}_{period}").alias("before"),
                F.col(f"scored_{kind}_{period}").alias("after"),
            )
            for kind in [*types, fixed.OTHER_TYPE]
            for period in fixed.PERIODS
        ]
    )
    return profile.select(fixed.PROVIDER, F.inline(cells))


def skipped_claims(
    counts: DataFrame, run_date: str | None = None, strict: bool = False
) -> DataFrame:
    """Where scored and raw counts differ: claims before and after the model saw them.

    A provider whose claims were all skipped is reported with 0, claims without a
    provider under a null one. ``strict=True`` leaves both out, as comparing with a
    missing count and joining by a null key do.
    """
    differs = (F.col("before") > 0) & (F.col("before") != F.col("after"))
    if strict:
        differs = differs & (F.col("after") > 0) & F.col(fixed.PROVIDER).isNotNull()
    return counts.where(differs).select(
        fixed.PROVIDER,
        fixed.CLAIM_TYPE,
        run_day(run_date).alias("run_date"),
        F.col("period").alias("before_after_educ"),
        "before",
        "after",
    )
