"""From test results and alert history to one flag per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift import fixed
from billshift.functions.dates import run_day
from billshift.functions.ids import as_id


def education_status(
    all_educated: DataFrame,
    educated_list: DataFrame,
    results: DataFrame,
    run_date: str | None = None,
    recent_days: int = fixed.RECENT_DAYS,
    strict: bool = False,
) -> DataFrame:
    """Result flag, or why there is none, per educated report.

    A report listed twice in ``educated_list`` counts once unless ``strict``. The
    recency label is the published text; its width is ``recent_days``.
    """
    used = educated_list.select(F.col(fixed.REPORT), F.lit(True).alias("used"))
    if not strict:
        used = used.distinct()
    outcome = results.select(as_id("provider_id").alias("subject"), "flag")
    joined = (
        all_educated.withColumn("subject", as_id(fixed.SUBJECT))
        .join(used, fixed.REPORT, "left")
        .join(outcome, "subject", "left")
    )
    age = F.datediff(run_day(run_date), F.col(fixed.MAX_ALERT_DATE))
    status = (
        F.when(F.col("flag").isNotNull(), F.col("flag"))
        .when(F.col("used").isNotNull(), fixed.FLAG_UNTESTABLE)
        .when(age <= recent_days, fixed.FLAG_RECENT)
        .otherwise(fixed.FLAG_NONE)
    )
    return joined.select(fixed.REPORT, status.alias("testing_flag"))


def education_not_n(status: DataFrame) -> DataFrame:
    return status.where(F.col("testing_flag") != fixed.FLAG_EFFECTIVE)


def n_reports(most_current: DataFrame, reports: DataFrame, results: DataFrame) -> DataFrame:
    """Reports whose provider was flagged N, with the education date."""
    flagged = results.where(F.col("flag") == fixed.FLAG_EFFECTIVE).select(
        as_id("provider_id").alias("subject"), "flag"
    )
    return (
        reports.withColumn("subject", as_id(fixed.SUBJECT))
        .join(flagged, "subject")
        .join(most_current, fixed.REPORT)
        .select(fixed.REPORT, fixed.EDUCATION_DATE, "flag", fixed.SUBJECT)
    )


def n_report_alerts(
    flagged_reports: DataFrame,
    report_alerts: DataFrame,
    alerts: DataFrame,
    models: DataFrame,
    statuses: Sequence[str] = tuple(fixed.LIVE_MODEL_STATUSES),
) -> DataFrame:
    """Alerts of the N reports that come from live models, each once.

    The flagged reports cut the association table down, and its repeats go, before
    alerts are attached. The shuffle by report and alert spreads a report with very many
    alerts; as the grouping does not reuse the join's partitions, adaptive execution may
    split that join in any session. No grouping follows the last joins, for the same reason.
    """
    live = models.where(F.col(fixed.MODEL_STATUS).isin(*statuses)).select(fixed.MODEL)
    links = (
        report_alerts.select(fixed.REPORT, fixed.ALERT)
        .join(flagged_reports, fixed.REPORT)
        .select(fixed.REPORT, fixed.EDUCATION_DATE, "flag", fixed.SUBJECT, fixed.ALERT)
        .repartition(fixed.REPORT, fixed.ALERT)
        .distinct()
    )
    known = alerts.select(fixed.ALERT, fixed.ALERT_DATE, fixed.MODEL).distinct()
    return (
        links.join(known, fixed.ALERT)
        .join(live, fixed.MODEL, "left_semi")
        .select(
            fixed.REPORT,
            fixed.EDUCATION_DATE,
            "flag",
            fixed.SUBJECT,
            fixed.ALERT_DATE,
            fixed.MODEL,
            fixed.ALERT,
        )
    )


def alerts_before(alerts: DataFrame) -> DataFrame:
    """Alerts before the education day. An alert on the day is in neither set."""
    return alerts.where(F.col(fixed.ALERT_DATE) < F.col(fixed.EDUCATION_DATE))


def alerts_after(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col(fixed.ALERT_DATE) > F.col(fixed.EDUCATION_DATE))


def n_flags(alerts: DataFrame) -> DataFrame:
    """``New Model`` or ``N`` for every N report with an alert before or after.

    A report is ``New Model`` when some later alert's model is not among its
    earlier ones, under NOT IN semantics: no earlier alerts make any later one new;
    a null among the earlier models, or as the later model, decides nothing.

    Alerts shrink to one row per report and model, then to one per report. Both
    steps add up before they shuffle, so a report with a third of all alerts costs
    no more than any other, and earlier and later alerts are never paired.
    """
    before = F.col(fixed.ALERT_DATE) < F.col(fixed.EDUCATION_DATE)
    after = F.col(fixed.ALERT_DATE) > F.col(fixed.EDUCATION_DATE)
    per_model = (
        alerts.where(before | after)
        .groupBy(fixed.REPORT, fixed.MODEL)
        .agg(F.bool_or(before).alias("earlier"), F.bool_or(after).alias("later"))
    )
    unknown = F.col(fixed.MODEL).isNull()
    per_report = per_model.groupBy(fixed.REPORT).agg(
        F.bool_or("earlier").alias("any_earlier"),
        F.bool_or("later").alias("any_later"),
        F.bool_or(F.col("earlier") & unknown).alias("earlier_unknown"),
        F.bool_or(F.col("later") & ~F.col("earlier") & ~unknown).alias("unseen_later"),
    )
    new = F.col("any_later") & (
        ~F.col("any_earlier") | (F.col("unseen_later") & ~F.col("earlier_unknown"))
    )
    return per_report.select(
        fixed.REPORT,
        F.when(new, fixed.FLAG_NEW_MODEL).otherwise(fixed.FLAG_EFFECTIVE).alias("testing_flag"),
    )


def new_model_reports(alerts: DataFrame) -> DataFrame:
    """N reports with a later alert from a model that had not alerted before."""
    return n_flags(alerts).where(F.col("testing_flag") == fixed.FLAG_NEW_MODEL)


def unchanged_reports(alerts: DataFrame) -> DataFrame:
    """N reports with alerts that are not new-model reports."""
    return n_flags(alerts).where(F.col("testing_flag") == fixed.FLAG_EFFECTIVE)


def all_flags(alerts: DataFrame, status: DataFrame) -> DataFrame:
    """New-model, unchanged-N and all other statuses together."""
    return n_flags(alerts).unionByName(education_not_n(status))


def sorted_flags(flags: DataFrame) -> DataFrame:
    """Flags in the order they are shown in; storing them does not keep it."""
    return flags.orderBy(fixed.REPORT, "testing_flag")


def increment(
    report_list: DataFrame,
    flags: DataFrame,
    run_date: str | None = None,
    strict: bool = False,
    date_col: str = "run_date",
    flag_col: str = "report_flag",
) -> DataFrame:
    """Dated flag of every report to publish, ``N/A`` where there is none.

    Identical flag rows count once unless ``strict``; differing flags of one report
    are all kept.
    """
    known = flags.select(fixed.REPORT, "testing_flag")
    if not strict:
        known = known.distinct()
    return report_list.select(fixed.REPORT).join(known, fixed.REPORT, "left").select(
        fixed.REPORT,
        run_day(run_date).alias(date_col),
        F.coalesce("testing_flag", F.lit(fixed.FLAG_NONE)).alias(flag_col),
    )
