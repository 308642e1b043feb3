"""The registered queries: every operator over the whole star-schema tables.

Measures are rounded because engines add doubles in different orders; dates are
shown as text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift import fixed
from billshift.functions.split import split_bucket
from billshift.operators import (
    audit, effect, features, lasso, metrics, optimality, params, prep, profiles, reports, splits, training, weights,
)
from billshift.operators.ranking import numbered
from billshift.plans import incremental, training_run
from billshift.sources import readers, star, writers

Query = Callable[[SparkSession, str], DataFrame]


def _dates_as_text(df: DataFrame) -> DataFrame:
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({d: F.col(d).cast("string") for d in dates})


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    # Adding zero turns -0.0 into 0.0.
    return df.withColumns({c: F.round(F.col(c), n) + F.lit(0.0) for c, n in places.items()})


# --- claims ---------------------------------------------------------------


def _scoring_claims(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    codes = [*fixed.code_columns("B"), *(fixed.NUMBERED_PROCEDURES if kind == "A" else [])]
    return star.claims(spark, sf_dir, kind, codes)


def scoring_frame(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = prep.prepare_scoring(_scoring_claims(spark, sf_dir, kind), kind)
        return _rounded(_dates_as_text(frame), CLM_SBMT_CHRG_AMT=2)

    return query


def blank_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = star.claims(spark, sf_dir, codes=fixed.code_columns("B"))
    frame = prep.upper_columns(prep.blank_to_token(prep.project_claims(claims, "B")))
    return _rounded(_dates_as_text(frame), CLM_SBMT_CHRG_AMT=2)


def training_frame(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(_training_claims(spark, sf_dir, kind), label=2)

    return query


def claims_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.row_count(star.claims(spark, sf_dir), [fixed.CLAIM_TYPE])


def claims_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = prep.claims_of_type(star.claims(spark, sf_dir), "DME")
    return _rounded(
        slices.select(fixed.PROVIDER, fixed.CLAIM_TYPE, "period", fixed.AMOUNT), clm_sbmt_chrg_amt=2
    )


# --- effect of the education ----------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.estimated(spark, sf_dir).where("scored")


def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = effect.residuals(_scored(spark, sf_dir))
    return _rounded(rows, clm_sbmt_chrg_amt=2, prediction=4, incorrect_billing_amt=4)


def residual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        effect.residual_stats(_scored(spark, sf_dir)), avg_incorrect=4, stdev_incorrect=4
    )


def _rounded_stats(df: DataFrame) -> DataFrame:
    names = [f"{m}_incorrect_{p}" for p in fixed.PERIODS for m in ("avg", "stdev")]
    return _rounded(df, **{name: 4 for name in names})


def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(effect.before_after(_scored(spark, sf_dir)))


def testable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(effect.testable(effect.before_after(_scored(spark, sf_dir))))


testable.__test__ = False


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return effect.test_results(effect.before_after(_scored(spark, sf_dir)))


def welch_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_results(spark, sf_dir), average_difference=4, t_value=6, p_value=6)


def welch_test_improved(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = effect.before_after(_scored(spark, sf_dir))
    rows = effect.test_results(stats, direction="improved")
    return _rounded(rows, average_difference=4, t_value=6, p_value=6)


def _audit(spark: SparkSession, sf_dir: str, strict: bool) -> DataFrame:
    counts = audit.claim_counts(star.estimated(spark, sf_dir), F.col("scored"))
    return _dates_as_text(audit.skipped_claims(counts, star.RUN_DATE, strict))


def skipped_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, strict=False)


def skipped_audit_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, strict=True)


def skipped_audit_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = effect.provider_profile(star.estimated(spark, sf_dir), F.col("scored"))
    counts = audit.profile_counts(profile)
    return _dates_as_text(audit.skipped_claims(counts, star.RUN_DATE))


# --- reports and alerts ---------------------------------------------------


def _stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test results as a written table: one row per provider, joined further on."""
    return writers.materialise(_results(spark, sf_dir), "results")


def _status(spark: SparkSession, sf_dir: str, results: DataFrame) -> DataFrame:
    return reports.education_status(
        star.all_educated(spark, sf_dir), star.educated_list(spark, sf_dir), results, star.RUN_DATE
    )


def _n_reports(spark: SparkSession, sf_dir: str, results: DataFrame) -> DataFrame:
    return reports.n_reports(
        star.most_current_education(spark, sf_dir), star.reports(spark, sf_dir), results
    )


def _alerts(spark: SparkSession, sf_dir: str, results: DataFrame) -> DataFrame:
    # Written first: from its true size Spark can tell whether to shuffle the alerts at all.
    flagged = writers.materialise(_n_reports(spark, sf_dir, results), "n_reports")
    found = reports.n_report_alerts(
        flagged,
        star.report_alerts(spark, sf_dir),
        star.alerts(spark, sf_dir),
        star.alert_models(spark, sf_dir),
    )
    # As in the whole run: what follows groups a stored table, not the join's partitions.
    return writers.materialise(found, "n_report_alerts")


def education_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(spark, sf_dir, _stored_results(spark, sf_dir))


def education_not_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.education_not_n(education_status(spark, sf_dir))


def n_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(_n_reports(spark, sf_dir, _stored_results(spark, sf_dir)))


def n_report_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(_alerts(spark, sf_dir, _stored_results(spark, sf_dir)))


def alerts_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(reports.alerts_before(_alerts(spark, sf_dir, _stored_results(spark, sf_dir))))


def alerts_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(reports.alerts_after(_alerts(spark, sf_dir, _stored_results(spark, sf_dir))))


def new_model_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.new_model_reports(_alerts(spark, sf_dir, _stored_results(spark, sf_dir)))


def unchanged_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unchanged_reports(_alerts(spark, sf_dir, _stored_results(spark, sf_dir)))


def all_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _stored_results(spark, sf_dir)
    return reports.all_flags(_alerts(spark, sf_dir, results), _status(spark, sf_dir, results))


def increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = all_flags(spark, sf_dir)
    return _dates_as_text(reports.increment(star.reports(spark, sf_dir), flags, star.RUN_DATE))


# --- training -------------------------------------------------------------


def _metrics(df: DataFrame) -> DataFrame:
    return _rounded(df, rmse=4, mse=2, r2=6, mae=4)


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    return _metrics(metrics.regression_metrics(rows, [fixed.CLAIM_TYPE], label=fixed.AMOUNT))


def metrics_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored metrics of three models, one table each, merged by column name."""
    rows = _scored(spark, sf_dir)
    by_type = metrics.regression_metrics(rows, [fixed.CLAIM_TYPE], label=fixed.AMOUNT)
    stored = writers.materialise(by_type, "metrics")
    tables = [
        prep.claims_of_type(stored, kind)
        .drop(fixed.CLAIM_TYPE)
        .select("*", F.lit(f"charge_{kind}").alias("model_name"))
        for kind in fixed.CLAIM_TYPES
    ]
    return _metrics(metrics.merge_metrics(tables))


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = split_bucket(star.ROW_KEY, portable=True)
    side = F.when(bucket < 70, "train").otherwise("holdout")
    rows = (
        star.claims(spark, sf_dir)
        .groupBy(fixed.CLAIM_TYPE, side.alias("side"))
        .agg(F.count("*").alias("n_rows"), F.sum(fixed.AMOUNT).alias("charged"))
    )
    return _rounded(rows, charged=2)


def _training_claims(
    spark: SparkSession, sf_dir: str, kind: str, keys: Sequence[str] = ()
) -> DataFrame:
    claims = star.claims(spark, sf_dir, kind, fixed.code_columns(kind))
    return prep.prepare_training(claims, kind, keys)


#: The code columns of all claim types.
ALL_CODES = list(dict.fromkeys(c for kind in fixed.CLAIM_TYPES for c in fixed.code_columns(kind)))
KINDS = {kind: features.stage_columns(kind) for kind in fixed.CLAIM_TYPES}


def _stored_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of all types with all codes, joined and written once, a folder per type."""
    claims = star.claims(spark, sf_dir, codes=ALL_CODES).where(F.col(fixed.CLAIM_TYPE).isNotNull())
    wanted = list(dict.fromkeys(c for kind in fixed.CLAIM_TYPES for c in prep.scoring_columns(kind)))
    codes = [c for c in ALL_CODES if c not in wanted]
    with writers.hashed_joins(spark):
        return writers.materialise(claims.select(*wanted, *codes, "period", fixed.CLAIM_TYPE), "claims", [fixed.CLAIM_TYPE])


def _stored_training(claims: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    with writers.hashed_joins(claims.sparkSession):
        return writers.materialise(prep.prepare_training_types(claims, keys=keys), "training", [fixed.CLAIM_TYPE])


def _training_of_all(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    return _stored_training(star.claims(spark, sf_dir, codes=ALL_CODES), keys)


def _levels(claims: DataFrame) -> DataFrame:
    return features.code_levels_by_type(claims, KINDS, fixed.CLAIM_TYPE)


def _shown(levels: DataFrame) -> DataFrame:
    return levels.withColumn("position", F.col("position").cast("bigint"))


def code_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_levels(prep.prepare_training_types(star.claims(spark, sf_dir, codes=ALL_CODES))))


def code_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of every code, numbered across partitions."""
    levels = writers.materialise(_levels(prep.prepare_training_types(star.claims(spark, sf_dir, codes=ALL_CODES))), "levels")
    return _shown(features.ranked_levels(levels, [fixed.CLAIM_TYPE]))


def feature_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims per position of the assembled vector: indexing, encoding, assembly.

    Only the positions that a claim has set are shuffled, counted per task before.
    """
    prepared = _training_of_all(spark, sf_dir)
    levels = writers.materialise(_levels(prepared), "levels")
    tables = []
    for kind in fixed.CLAIM_TYPES:
        claims = prep.training_of(prepared, kind)
        stages = features.fit_features(claims, kind, prep.claims_of_type(levels, kind))
        vectors = PipelineModel(stages).transform(claims).select(F.unwrap_udt("features").alias("v"))
        dense = F.sequence(F.lit(0), F.size("v.values") - 1)
        entry = F.arrays_zip(F.coalesce("v.indices", dense).alias("at"), F.col("v.values").alias("set"))
        active = (
            vectors.select(F.inline(entry).alias("position", "set"))
            .where(F.col("set") != 0)
            .groupBy(F.col("position").cast("bigint").alias("id"))
            .agg(F.count("*").alias("n"))
        )
        encoder = next(s for s in stages if isinstance(s, OneHotEncoderModel))
        width = sum(size - 1 for size in encoder.categorySizes)
        tables.append(
            spark.range(width)
            .join(active, "id", "left")
            .select(
                F.lit(kind).alias(fixed.CLAIM_TYPE),
                F.col("id").alias("position"),
                F.coalesce("n", F.lit(0).cast("bigint")).alias("n_rows"),
            )
        )
    return metrics.merge_metrics(tables)


def scored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims per type and period, and how many the saved and reloaded model scores."""
    root = writers.scratch_path(spark, "models")
    stored = _stored_claims(spark, sf_dir)
    learn = prep.prepare_training_types(stored.where(F.col("period") == "before"))
    tables = []
    for kind in fixed.CLAIM_TYPES:
        writers.save_pipeline(root, fixed.MODEL_FOLDERS[kind], training.fit(prep.training_of(learn, kind), kind))
        model = readers.load_pipeline(root, fixed.MODEL_FOLDERS[kind])
        tables.append(
            training.score_marked(model, prep.prepare_scoring(stored, kind)).select(
                fixed.CLAIM_TYPE, "period", (F.col("scored") & F.col("prediction").isNotNull()).alias("ok")
            )
        )
    return (
        metrics.merge_metrics(tables)
        .groupBy(fixed.CLAIM_TYPE, "period")
        .agg(F.count("*").alias("n_claims"), F.count_if("ok").alias("n_scored"))
    )


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training run's three stored evaluations, merged: sizes, and whether the model beats the mean."""
    claims = star.claims(spark, sf_dir, codes=ALL_CODES)
    root = writers.scratch_path(spark, "training-run")
    kinds = dict.fromkeys(fixed.CLAIM_TYPES, claims)
    stored = training_run.train_all(spark, kinds, root, keys=star.ROW_KEY, portable=True)
    return stored.select("model_name", "train_size", "n_rows", (F.col("r2") > 0.1).alias("beats_mean"))


def ml_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out metrics of the fitted regression, per claim type."""
    prepared = _training_of_all(spark, sf_dir, star.ROW_KEY)
    tables = []
    for kind in fixed.CLAIM_TYPES:
        learn, holdout = training.hash_split(prep.training_of(prepared, kind, star.ROW_KEY), star.ROW_KEY)
        row = training.evaluate(training.fit(learn, kind), holdout)
        tables.append(row.select(F.lit(f"charge_{kind}").alias("model_name"), "*"))
    return _metrics(metrics.merge_metrics(tables))


def ml_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test results with predictions of the fitted regressions instead of the line."""
    stored = _stored_claims(spark, sf_dir)
    learn = prep.prepare_training_types(stored.where(F.col("period") == "before"))
    scored = []
    for kind in fixed.CLAIM_TYPES:
        model = training.fit(prep.training_of(learn, kind), kind)
        scored.append(effect.residuals(training.score(model, prep.prepare_scoring(stored, kind))))
    stats = effect.before_after(metrics.merge_metrics(scored))
    return _rounded(effect.test_results(stats), average_difference=2, t_value=4, p_value=4)


def lasso_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type and feature of the fitted and refined regressions: how far from optimal.

    ``violation`` is of the subgradient condition (the penalty is 0.1), ``gap_share`` the
    duality gap as a share of the loss.
    """
    prepared = _training_of_all(spark, sf_dir)
    levels = writers.materialise(_levels(prepared), "levels")
    tables = []
    for kind in fixed.CLAIM_TYPES:
        claims = prep.training_of(prepared, kind)
        model = training.fit(claims, kind, levels=prep.claims_of_type(levels, kind))
        fitted = writers.materialise(weights.model_weights(spark, model), "weights", ["position"])
        table = writers.materialise(lasso.refine(claims, fitted, KINDS[kind]), "weights", ["position"])
        scored = writers.materialise(weights.score_by_weights(claims, table, KINDS[kind]), "scored")
        gradients = writers.materialise(optimality.subgradients(scored, table, KINDS[kind]), "gradients")
        gap = optimality.duality_gap(scored, gradients).first()
        tables.append(
            gradients.select(
                F.lit(kind).alias(fixed.CLAIM_TYPE), "feature", F.col("position").cast("bigint").alias("position"), "code",
                F.col("n").alias("n_rows"), "scale", "violation", F.lit(gap["gap"] / gap["primal"]).alias("gap_share"),
            )
        )
    return _rounded(metrics.merge_metrics(tables), scale=6, violation=2, gap_share=3)


def _effects(learn: DataFrame) -> dict[str, DataFrame]:
    """Stored weights per claim type, in a closed form that SQL can state too."""
    return {
        kind: writers.materialise(star.code_effects(prep.training_of(learn, kind), columns), "weights", ["position"])
        for kind, columns in KINDS.items()
    }


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of all types, both periods, scored by stored weights, with their residuals."""
    stored = _stored_claims(spark, sf_dir)
    table = _effects(prep.prepare_training_types(stored.where(F.col("period") == "before")))
    scored = [
        weights.score_by_weights(prep.prepare_scoring(stored, kind), table[kind], columns, joined=True).where("scored")
        for kind, columns in KINDS.items()
    ]
    rows = metrics.merge_metrics([effect.residuals(s) for s in scored])
    return _rounded(rows, clm_sbmt_chrg_amt=2, prediction=2, incorrect_billing_amt=2)


def evaluation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows computed from stored hold-out predictions, one model per type."""
    prepared = _training_of_all(spark, sf_dir, star.ROW_KEY)
    learn, holdout = training.hash_split(prepared, star.ROW_KEY, portable=True)
    table = _effects(learn)
    rows = []
    for kind, columns in KINDS.items():
        scored = weights.score_by_weights(prep.training_of(holdout, kind), table[kind], columns).where("scored")
        path = writers.scratch_path(spark, f"holdout-{kind}")
        writers.write_table(scored.select("label", "prediction"), path)
        size = prep.claims_of_type(learn, kind).count()
        row = metrics.regression_metrics(readers.read_table(spark, path))
        rows.append(training.evaluation_row(row, f"charge_{kind}", "2001-12-31 00:00:00", 1.0, size))
    return _rounded(metrics.merge_metrics(rows), rmse=2, mse=0, r2=6, mae=2)


def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = star.claims(spark, sf_dir)
    sides = splits.exact_split(claims, star.ROW_KEY, [fixed.CLAIM_TYPE])
    tables = [df.withColumn("side", F.lit(side)) for side, df in zip(("train", "holdout"), sides)]
    rows = metrics.merge_metrics(tables).groupBy(fixed.CLAIM_TYPE, "side")
    return _rounded(rows.agg(F.count("*").alias("n_rows"), F.sum(fixed.AMOUNT).alias("charged")), charged=2)


def stale_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims that come with predictions of another model: these are dropped before scoring."""
    learn = _training_claims(spark, sf_dir, "DME").where(F.col("label") < 50_000)
    model = training.fit(writers.materialise(learn, "training"), "DME")
    claims = _training_claims(spark, sf_dir, "DME").withColumn("prediction", F.lit(-1e9))
    scored = training.score(model, claims, by_stages=True).withColumn("stale", F.col("prediction") == -1e9)
    return scored.groupBy("stale").agg(F.count("*").alias("n_rows"))


# --- profiles kept by day -------------------------------------------------


def _daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile after three days, one of which came late and one twice."""
    root = writers.scratch_path(spark, "profile")
    claims = star.estimated(spark, sf_dir)
    of = {f"2001-12-{29 + part}": claims.where(F.pmod("l_orderkey", F.lit(3)) == part) for part in range(3)}
    first, late, last = of
    incremental.add_day(spark, root, first, of[first], F.col("scored"))
    incremental.add_day(spark, root, last, of[late], F.col("scored"))
    incremental.add_day(spark, root, late, of[late], F.col("scored"))
    return incremental.add_day(spark, root, last, of[last], F.col("scored"))


def daily_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(effect.profile_stats(_daily_profile(spark, sf_dir)))


def daily_skipped_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = audit.profile_counts(_daily_profile(spark, sf_dir))
    return _dates_as_text(audit.skipped_claims(counts, star.RUN_DATE))


def merged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of both periods from profiles of the three claim types, merged pairwise."""
    claims = star.estimated(spark, sf_dir)
    first, *rest = (
        writers.materialise(effect.provider_profile(prep.claims_of_type(claims, kind), F.col("scored")), f"profile-{kind}")
        for kind in fixed.CLAIM_TYPES
    )
    for profile in rest:
        first = profiles.merge_profiles(first, profile)
    return _rounded_stats(effect.profile_stats(first))


# --- stored tables --------------------------------------------------------


def stored_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by path, overwritten by one with other columns."""
    path = writers.scratch_path(spark, "overwritten")
    claims = star.claims(spark, sf_dir)
    writers.write_table(metrics.row_count(claims, [fixed.CLAIM_TYPE]), path)
    totals = claims.groupBy(fixed.CLAIM_TYPE).agg(F.sum("l_quantity").alias("quantity"))
    writers.write_table(totals, path, replace_schema=True)
    return _rounded(readers.read_table(spark, path), quantity=2)


def _table_name(path: str) -> str:
    return "billshift_" + path.rsplit("-", 1)[1]


def stored_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered external table, read by name and by query."""
    path = writers.scratch_path(spark, "registered")
    name = _table_name(path)
    writers.write_table(claims_by_type(spark, sf_dir), path)
    writers.register_table(spark, name, path)
    by_name = prep.claims_of_type(readers.read_catalog(spark, name), "B")
    by_query = readers.read_query(spark, f"SELECT clm_src_type, cnt FROM {name} WHERE clm_src_type = 'DME'")
    return by_name.unionByName(by_query)


def stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published days, one of them published again with other rows."""
    path = writers.scratch_path(spark, "days")
    counts = star.claims(spark, sf_dir).groupBy(fixed.CLAIM_TYPE, "period").agg(F.count("*").alias("cnt"))
    counts = writers.materialise(counts, "counts")
    before, after = (counts.where(F.col("period") == p).drop("period") for p in fixed.PERIODS)
    for day, rows in (("2001-12-30", before), ("2001-12-31", before), ("2001-12-30", after)):
        writers.publish_increment(rows, path, day)
    return _dates_as_text(readers.read_table(spark, path))


def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog tables by ``send`` and ``persist_df``, each overwritten once."""
    key = _table_name(writers.scratch_path(spark, "sent"))
    rows = writers.materialise(claims_by_type(spark, sf_dir), "by-type")
    schema = spark.catalog.currentDatabase()
    for part in (rows.limit(0), rows):
        sent = writers.send(part, key, fixed.RESULT_SUFFIXES[0], schema)
        persisted = writers.persist_df(part, f" {key}_Kept ", schema)
    tables = {"sent": sent, "persisted": persisted}
    return metrics.merge_metrics(
        [readers.read_catalog(spark, name).select(F.lit(label).alias("name"), "*") for label, name in tables.items()]
    )


def stored_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged table by its pointer and by its catalog name, replaced twice: by more rows, then by other columns."""
    root = writers.scratch_path(spark, "staged")
    name = _table_name(root)
    claims = star.claims(spark, sf_dir)
    counts = writers.materialise(metrics.row_count(claims, [fixed.CLAIM_TYPE]), "counts")
    writers.replace_table(counts.limit(1), root, name)
    writers.replace_table(counts, root, name)
    by_name = readers.read_catalog(spark, name).select(F.lit("rows").alias("name"), fixed.CLAIM_TYPE, F.col("cnt").cast("double").alias("value"))
    by_name = writers.materialise(by_name, "replaced")
    totals = claims.groupBy(fixed.CLAIM_TYPE).agg(F.sum("l_quantity").alias("quantity"))
    writers.replace_table(totals, root, name)
    by_pointer = readers.read_current(spark, root).select(F.lit("quantity").alias("name"), fixed.CLAIM_TYPE, F.col("quantity").alias("value"))
    return _rounded(by_name.unionByName(by_pointer), value=2)


def stored_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of claims published in one job; then some of them again with other rows, one without any."""
    path = writers.scratch_path(spark, "backfill")
    days = F.to_date(F.concat(F.date_format(fixed.SERVICE_DATE, "yyyy-MM"), F.lit("-01")))
    claims = star.claims(spark, sf_dir).withColumn("run_date", days)
    counts = claims.groupBy("run_date", fixed.CLAIM_TYPE, "period").agg(F.count("*").alias("cnt"))
    counts = writers.materialise(counts, "counts")
    writers.publish_days(counts, path)
    again = counts.where((F.year("run_date") == 1996) & (F.month("run_date") != 5) & (F.col("period") == "before"))
    for _ in range(2):
        writers.publish_days(again, path, days=["1996-05-01"])
    return _dates_as_text(readers.read_table(spark, path))


def persisted_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table persisted without naming a schema, overwritten once."""
    rows = writers.materialise(claims_by_type(spark, sf_dir), "by-type")
    key = _table_name(writers.scratch_path(spark, "default"))
    for part in (rows.limit(1), rows):
        name = writers.persist_df(part, f"  {key.upper()} ")
    return readers.read_catalog(spark, name)


def flags_in_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags stored in order and numbered as they stand in the files, file after file."""
    path = writers.scratch_path(spark, "ordered")
    writers.write_ordered(all_flags(spark, sf_dir), path, [fixed.REPORT, "testing_flag"])
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return numbered(rows, ["file", "row"], "place", start=1).drop("file", "row")


def flags_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sorted_flags(all_flags(spark, sf_dir))


# --- configuration --------------------------------------------------------


def config_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.last_params(star.config(spark, sf_dir), "p_partkey")


def params_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maps, shown as sorted ``key=value`` text."""
    maps = params.params_map(star.config(spark, sf_dir), "p_partkey")
    pairs = F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return maps.select(
        F.col(fixed.CONFIG_MODEL), F.array_join(F.array_sort(pairs), ";").alias("params")
    )


def model_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.params_frame(star.config(spark, sf_dir), "STANDARD")


def missing_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models that alerts name and the registry of live models lacks."""
    live = star.alert_models(spark, sf_dir).where(
        F.col(fixed.MODEL_STATUS).isin(fixed.LIVE_MODEL_STATUSES)
    )
    return params.missing_models(star.alerts(spark, sf_dir), live, fixed.MODEL)


def known_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the registry holds a model: one it has, and one it lacks."""
    registry = star.config(spark, sf_dir)
    rows = [(name, params.has_model(registry, name)) for name in ("STANDARD", "ABSENT")]
    return spark.createDataFrame(rows, f"{fixed.CONFIG_MODEL} string, known boolean")


QUERIES: dict[str, Query] = {
    "blank_token": blank_token,
    "scoring_frame_a": scoring_frame("A"),
    "scoring_frame_b": scoring_frame("B"),
    "scoring_frame_dme": scoring_frame("DME"),
    "training_frame_a": training_frame("A"),
    "training_frame_b": training_frame("B"),
    "training_frame_dme": training_frame("DME"),
    "claims_by_type": claims_by_type,
    "claims_of_type": claims_of_type,
    "residuals": residuals,
    "residual_stats": residual_stats,
    "before_after": before_after,
    "testable": testable,
    "welch_test": welch_test,
    "welch_test_improved": welch_test_improved,
    "skipped_audit": skipped_audit,
    "skipped_audit_strict": skipped_audit_strict,
    "skipped_audit_profile": skipped_audit_profile,
    "education_status": education_status,
    "education_not_n": education_not_n,
    "n_reports": n_reports,
    "n_report_alerts": n_report_alerts,
    "alerts_before": alerts_before,
    "alerts_after": alerts_after,
    "new_model_reports": new_model_reports,
    "unchanged_reports": unchanged_reports,
    "all_flags": all_flags,
    "increment": increment,
    "regression_metrics": regression_metrics,
    "metrics_merge": metrics_merge,
    "hash_split": hash_split,
    "code_levels": code_levels,
    "code_ranks": code_ranks,
    "feature_activity": feature_activity,
    "lasso_optimality": lasso_optimality,
    "predictions": predictions,
    "evaluation_rows": evaluation_rows,
    "exact_split": exact_split,
    "stale_prediction": stale_prediction,
    "daily_before_after": daily_before_after,
    "daily_skipped_audit": daily_skipped_audit,
    "merged_profiles": merged_profiles,
    "ml_evaluation": ml_evaluation,
    "ml_train_score": ml_train_score,
    "scored_counts": scored_counts,
    "evaluations": evaluations,
    "stored_overwrite": stored_overwrite,
    "stored_catalog": stored_catalog,
    "stored_days": stored_days,
    "stored_results": stored_results,
    "stored_replaced": stored_replaced,
    "stored_backfill": stored_backfill,
    "persisted_default": persisted_default,
    "flags_sorted": flags_sorted,
    "flags_in_file_order": flags_in_file_order,
    "config_params": config_params,
    "params_map": params_map,
    "model_params": model_params,
    "missing_models": missing_models,
    "known_models": known_models,
}
