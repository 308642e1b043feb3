"""Vocabularies, the fitted pipeline and its metrics against Spark ML's own stages."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators import features, metrics, training

COLUMNS = features.stage_columns("B")


@pytest.fixture(scope="module")
def claims(spark):
    """Codes with ties, blanks and nulls in several columns."""
    rng = random.Random(3)

    def row(i):
        codes = [f"c{rng.randint(0, 2 + j % 4)}" for j in range(len(COLUMNS))]
        for j in (1, 5, 8):
            if rng.random() < 0.08:
                codes[j] = None
        return (*codes, 100.0 + 10 * rng.random() + (30.0 if codes[0] == "c1" else 0.0), i)

    schema = ", ".join(f"{c} string" for c in COLUMNS) + ", label double, id bigint"
    return spark.createDataFrame([row(i) for i in range(600)], schema).persist()


def one_after_another():
    """Separate indexer and encoder per column, fitted in sequence."""
    stages = []
    for c in COLUMNS:
        stages += [
            StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="skip"),
            OneHotEncoder(inputCols=[f"{c}_i"], outputCols=[f"{c}_e"]),
        ]
    return [*stages, VectorAssembler(inputCols=[f"{c}_e" for c in COLUMNS], outputCol="features")]


def test_vocabularies_equal_sequential_fits(claims):
    fitted = features.fit_features(claims, "B")
    mine = [s.labels for s in fitted if isinstance(s, StringIndexerModel)]
    sequential = Pipeline(stages=one_after_another()).fit(claims)
    theirs = [s.labels for s in sequential.stages if isinstance(s, StringIndexerModel)]
    assert mine == theirs


def test_feature_vectors_and_predictions_equal_sequential_fits(claims):
    mine = training.fit(claims, "B")
    theirs = Pipeline(stages=[*one_after_another(), training.charge_regressor()]).fit(claims)
    a, b = (
        {r["id"]: r for r in m.transform(claims).select("id", "features", "prediction").collect()}
        for m in (mine, theirs)
    )
    assert a.keys() == b.keys() and 0 < len(a) < 600
    for i in a:
        assert a[i]["features"] == b[i]["features"]
        assert a[i]["prediction"] == pytest.approx(b[i]["prediction"], abs=1e-6)


def test_unseen_and_missing_codes_are_skipped(spark, claims):
    model = training.fit(claims, "B")
    good = claims.na.drop().limit(1)
    unseen = good.withColumn(COLUMNS[0], F.lit("never seen"))
    missing = good.withColumn(COLUMNS[4], F.lit(None).cast("string"))
    assert training.score(model, good.unionByName(unseen).unionByName(missing)).count() == 1


def test_stale_predictions_are_replaced(claims):
    model = training.fit(claims, "B")
    stale = claims.withColumn("prediction", F.lit(-1.0))
    assert training.score(model, stale).where("prediction = -1").isEmpty()


def test_constant_column_and_missing_labels(claims):
    """Where the plain stages fail: one level only, and null labels."""
    df = claims.withColumn(COLUMNS[3], F.lit("same")).withColumn(
        "label", F.when(F.col("id") % 10 != 0, F.col("label"))
    )
    stages = features.fit_features(df, "B")
    assert features.constant_columns(stages) == [COLUMNS[3]]
    model = training.fit(df, "B")
    assert training.score(model, df.where("id = 1").withColumn(COLUMNS[3], F.lit("new"))).isEmpty()


def test_unfitted_pipeline_fits_too(claims):
    pipeline = training.training_pipeline("B")
    assert len(pipeline.getStages()) == 4
    assert pipeline.fit(claims.na.drop()).transform(claims).count() > 0


def test_metrics_equal_the_evaluator(claims):
    model = training.fit(claims, "B")
    scored = training.score(model, claims).select("prediction", "label").persist()
    row = metrics.regression_metrics(scored).first()
    for name in ("rmse", "mse", "r2", "mae"):
        assert row[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(scored))


def test_metrics_of_constant_labels_and_nothing(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "prediction double, label double")
    row = metrics.regression_metrics(flat).first()
    assert row["mse"] == 1.0 and row["r2"] is None
    assert metrics.regression_metrics(flat.limit(0)).first()["n_rows"] == 0


@pytest.mark.parametrize("portable", [False, True])
def test_hash_split_ignores_partitioning(claims, portable):
    one = training.hash_split(claims.repartition(2), ["id"], portable=portable)
    two = training.hash_split(claims.repartition(7, "label"), ["id"], portable=portable)
    for a, b in zip(one, two):
        assert {r["id"] for r in a.collect()} == {r["id"] for r in b.collect()}
    assert one[0].count() + one[1].count() == 600
    assert 0.6 < one[0].count() / 600 < 0.8


def test_random_split_covers_everything(claims):
    parts = training.random_split(claims)
    assert sum(p.count() for p in parts) == 600


def test_train_saves_model_and_evaluation(spark, claims, tmp_path):
    model = training.train(claims, "B", str(tmp_path), str(tmp_path / "evaluation"), keys=["id"])
    row = spark.read.parquet(str(tmp_path / "evaluation")).first()
    assert (row["model_name"], row["algorithm"]) == ("charge_B", fixed.ALGORITHM)
    assert 0 < row["train_size"] < 600 and row["rmse"] > 0
    published = training.as_published(spark.read.parquet(str(tmp_path / "evaluation")))
    assert published.columns[-4:] == [
        "Root_Mean_Sqaured_Error",
        "Mean_Squared_Error",
        "R_Squared",
        "Mean_Absolute_Error",
    ]
    again = PipelineModel.load(str(tmp_path / "partb" / "trainedpipeline"))
    a, b = (m.transform(claims).agg(F.sum("prediction")).first()[0] for m in (model, again))
    assert a == b
