"""From raw claims and alert history to the published flag of every report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators import audit, effect, reports
from billshift.operators.metrics import merge_metrics
from billshift.operators.features import stage_columns
from billshift.operators.prep import prepare_scoring, with_periods
from billshift.operators.training import score_marked
from billshift.operators.weights import score_by_weights
from billshift.sources import readers
from billshift.sources.readers import load_pipeline, read_table
from billshift.sources.writers import publish_increment, register_table, replace_table, write_table


@dataclass(frozen=True)
class Inputs:
    """Source tables. Claims of type A come in tables of their own."""

    claims_before: DataFrame
    claims_after: DataFrame
    claims_before_a: DataFrame
    claims_after_a: DataFrame
    most_current_education: DataFrame
    reports: DataFrame
    report_alerts: DataFrame
    alerts: DataFrame
    alert_models: DataFrame
    all_educated: DataFrame
    educated_list: DataFrame
    report_list: DataFrame


def load_models(root: str) -> dict[str, PipelineModel]:
    """The fitted pipelines that ``train_all`` saved."""
    return {kind: load_pipeline(root, folder) for kind, folder in fixed.MODEL_FOLDERS.items()}


def load_weights(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The weights tables that ``train_all`` stored beside the pipelines."""
    return {kind: readers.load_weights(spark, root, folder) for kind, folder in fixed.MODEL_FOLDERS.items()}


def claims_by_kind(inputs: Inputs) -> dict[str, DataFrame]:
    shared = with_periods(inputs.claims_before, inputs.claims_after)
    own = with_periods(inputs.claims_before_a, inputs.claims_after_a)
    return {"A": own, "B": shared, "DME": shared}


def marked_claims(inputs: Inputs, models: Mapping[str, PipelineModel | DataFrame]) -> DataFrame:
    """Claims of all types, each read once: prediction, and whether the model could score it.

    A model is a fitted pipeline or its weights table; both score alike.
    """

    def scored(kind: str, claims: DataFrame) -> DataFrame:
        model, frame = models[kind], prepare_scoring(claims, kind)
        if isinstance(model, DataFrame):
            return score_by_weights(frame, model, stage_columns(kind))
        return score_marked(model, frame)

    return merge_metrics(
        [
            scored(kind, df).select(*_KEYS, fixed.AMOUNT, "prediction", "scored")
            for kind, df in claims_by_kind(inputs).items()
        ]
    )


def run(
    spark: SparkSession,
    inputs: Inputs,
    models: Mapping[str, PipelineModel | DataFrame],
    out: str,
    run_date: str,
    schema: str | None = None,
    strict: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Score, test, audit, flag and publish; returns the day's increment.

    Each stage is written under ``out`` and read back by the next, so nothing above
    it runs again, whatever executors are lost. Claims are scored once: the provider
    profile, one row per provider, serves the test and the audit. With ``schema``
    every table is registered there. ``staged`` replaces the stored tables by versions, so
    that a run that dies leaves those of the run before (``readers.read_current``).
    """

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{out.rstrip('/')}/{name}"
        if staged:
            replace_table(df, path, None if schema is None else f"{schema}.{name}")
            return readers.read_current(spark, path)
        write_table(df, path, replace_schema=True)
        if schema is not None:
            return register_table(spark, f"{schema}.{name}", path)
        return read_table(spark, path)

    def publish(df: DataFrame, name: str) -> DataFrame:
        path = f"{out.rstrip('/')}/{name}"
        publish_increment(df, path, run_date)
        if schema is not None:
            register_table(spark, f"{schema}.{name}", path)
        return read_table(spark, path).where(F.col("run_date") == F.lit(run_date).cast("date"))

    claims = marked_claims(inputs, models)
    profile = store(effect.provider_profile(claims, F.col("scored")), "provider_profile")

    results = store(effect.test_results(effect.profile_stats(profile)), "test_result")
    counts = audit.profile_counts(profile)
    publish(audit.skipped_claims(counts, run_date, strict), "skipped_claims")

    status = store(
        reports.education_status(
            inputs.all_educated, inputs.educated_list, results, run_date, strict=strict
        ),
        "education_status",
    )
    flagged = store(
        reports.n_reports(inputs.most_current_education, inputs.reports, results), "n_reports"
    )
    alerts = store(
        reports.n_report_alerts(flagged, inputs.report_alerts, inputs.alerts, inputs.alert_models),
        "n_report_alerts",
    )
    store(reports.alerts_before(alerts), "alerts_before")
    store(reports.alerts_after(alerts), "alerts_after")
    n_flags = store(reports.n_flags(alerts), "n_flags")
    flags = store(n_flags.unionByName(reports.education_not_n(status)), "all_flags")

    return publish(reports.increment(inputs.report_list, flags, run_date, strict), "increment")


_KEYS = [fixed.PROVIDER, fixed.CLAIM_TYPE, "period"]
