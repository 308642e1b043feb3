"""Both whole runs on the star-schema claims."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators import effect, prep, reports, training
from billshift.plans import flag_run, training_run
from billshift.sources import readers, star

CODES = [*fixed.code_columns("B"), *fixed.NUMBERED_PROCEDURES]


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    def claims(period, kinds):
        df = star.claims(spark, sf_dir, codes=CODES).where(F.col("period") == period)
        return df.where(F.col(fixed.CLAIM_TYPE).isin(kinds)).drop("period")

    return flag_run.Inputs(
        claims_before=claims("before", ["B", "DME"]),
        claims_after=claims("after", ["B", "DME"]),
        claims_before_a=claims("before", ["A"]).drop(fixed.CLAIM_TYPE),
        claims_after_a=claims("after", ["A"]).drop(fixed.CLAIM_TYPE),
        most_current_education=star.most_current_education(spark, sf_dir),
        reports=star.reports(spark, sf_dir),
        report_alerts=star.report_alerts(spark, sf_dir),
        alerts=star.alerts(spark, sf_dir),
        alert_models=star.alert_models(spark, sf_dir),
        all_educated=star.all_educated(spark, sf_dir),
        educated_list=star.educated_list(spark, sf_dir),
        report_list=star.reports(spark, sf_dir).select(fixed.REPORT),
    )


@pytest.fixture(scope="module")
def trained(spark, inputs, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("models"))
    shared = inputs.claims_before
    claims = {"A": inputs.claims_before_a, "B": shared, "DME": shared}
    return root, training_run.train_all(spark, claims, root, keys=star.ROW_KEY, table="evaluation")


def test_training_run(spark, trained):
    root, evaluation = trained
    assert sorted(r["model_name"] for r in evaluation.collect()) == ["charge_A", "charge_B", "charge_DME"]
    assert spark.table("evaluation").count() == 3
    assert flag_run.load_models(root).keys() == set(fixed.CLAIM_TYPES)


def test_flag_run(spark, inputs, trained, tmp_path):
    models = flag_run.load_models(trained[0])
    spark.sql("CREATE SCHEMA IF NOT EXISTS flags_db")
    out = str(tmp_path)
    for _ in range(2):  # a rerun of the day changes nothing
        published = flag_run.run(spark, inputs, models, out, star.RUN_DATE, schema="flags_db")
    assert published.count() == inputs.report_list.count()
    assert {r["report_flag"] for r in published.collect()} >= {"N/A", "Y"}

    profile = spark.table("flags_db.provider_profile")
    raw = sum(F.col(c) for c in profile.columns if c.startswith("raw_"))
    claims = [inputs.claims_before, inputs.claims_after, inputs.claims_before_a, inputs.claims_after_a]
    assert profile.agg(F.sum(raw)).first()[0] == sum(c.count() for c in claims)

    skipped = spark.read.parquet(f"{out}/skipped_claims")
    assert skipped.count() == skipped.distinct().count() > 0
    assert skipped.where("after >= before").isEmpty()

    assert spark.table("flags_db.skipped_claims").count() == skipped.count()
    assert spark.table("flags_db.increment").count() == published.count()

    alerts = spark.table("flags_db.n_report_alerts")
    assert spark.table("flags_db.alerts_before").count() == reports.alerts_before(alerts).count()
    flagged = {r[0] for r in spark.table("flags_db.n_reports").select("asrpt_id").collect()}
    assert {r[0] for r in spark.table("flags_db.n_flags").select("asrpt_id").collect()} <= flagged


def test_marked_claims_are_read_once_and_agree_with_skipping(spark, inputs, trained, tmp_path):
    models = flag_run.load_models(trained[0])
    stored = {}
    for name in ("claims_before", "claims_after", "claims_before_a", "claims_after_a"):
        getattr(inputs, name).write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    inputs = dataclasses.replace(inputs, **stored)
    marked = flag_run.marked_claims(inputs, models)
    profile = effect.provider_profile(marked, F.col("scored"))
    # Types B and DME share the tables of two periods, type A has two of its own.
    assert profile._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 6
    for kind, claims in flag_run.claims_by_kind(inputs).items():
        skipping = training.score(models[kind], prep.prepare_scoring(claims, kind))
        columns = [fixed.PROVIDER, fixed.AMOUNT, "period", F.round("prediction", 6).alias("p")]
        mine = marked.where(F.col(fixed.CLAIM_TYPE) == kind)
        assert mine.where("scored").select(columns).exceptAll(skipping.select(columns)).isEmpty()
        assert mine.where("scored").count() == skipping.count() < mine.count()
        assert mine.where("not scored and prediction is not null").isEmpty()


def test_scored_and_skipped_add_up(spark, inputs, trained):
    models = flag_run.load_models(trained[0])
    frame = prep.prepare_scoring(flag_run.claims_by_kind(inputs)["DME"], "DME")
    codes = [c.upper() for c in fixed.code_columns("DME")]
    complete = frame.na.drop(subset=codes).count()
    scored = models["DME"].transform(frame).count()
    assert 0 < scored <= complete < frame.count()


def test_weights_score_like_the_pipelines(spark, inputs, trained):
    tables = flag_run.load_weights(spark, trained[0])
    columns = [fixed.PROVIDER, fixed.CLAIM_TYPE, "period", fixed.AMOUNT, "scored", F.round("prediction", 6).alias("p")]
    by_weights = flag_run.marked_claims(inputs, tables).select(columns)
    by_pipeline = flag_run.marked_claims(inputs, flag_run.load_models(trained[0])).select(columns)
    assert by_weights.where("scored").count() > 0
    assert by_weights.exceptAll(by_pipeline).isEmpty() and by_pipeline.exceptAll(by_weights).isEmpty()


def test_staged_flag_run(spark, inputs, trained, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS staged_db")
    tables = flag_run.load_weights(spark, trained[0])
    out = str(tmp_path)
    for _ in range(2):
        published = flag_run.run(spark, inputs, tables, out, star.RUN_DATE, schema="staged_db", staged=True)
    assert published.count() == inputs.report_list.count()
    for name in ("provider_profile", "test_result", "all_flags"):
        current = readers.read_current(spark, f"{out}/{name}")
        assert spark.table(f"staged_db.{name}").count() == current.count()
        assert len(list((tmp_path / name / "versions").iterdir())) == 2
