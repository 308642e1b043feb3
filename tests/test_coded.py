"""Passes with codes looked up in Arrow: same results as vectors per claim, and no row per pair of codes."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from billshift.operators import features, lasso, training, weights
from billshift.operators.coded import code_moments
from billshift.sources.writers import materialise

COLUMNS = features.stage_columns("B")


@pytest.fixture(scope="module")
def claims(spark):
    """Null and blank codes, missing labels, a column of one level, one code on few claims."""
    rng = random.Random(8)

    def row(i):
        codes = [f"c{rng.randint(0, 2 + j % 3)}" for j in range(len(COLUMNS))]
        codes[3], codes[4] = "only", "rare" if i % 97 == 0 else codes[4]
        if rng.random() < 0.1:
            codes[rng.randint(0, len(COLUMNS) - 1)] = None
        return (*codes, None if i % 50 == 7 else 1e5 + 10 * rng.random() + 300.0 * (codes[0] == "c1"), i)

    schema = ", ".join(f"{c} string" for c in COLUMNS) + ", label double, id bigint"
    return spark.createDataFrame([row(i) for i in range(800)], schema).persist()


def test_fit_equals_the_fit_to_vectors(claims):
    mine = training.fit(claims, "B")
    labelled = claims.where("label is not null")
    vectors = PipelineModel(mine.stages[:-1]).transform(labelled).select("features", "label")
    theirs = training.charge_regressor().fit(vectors)
    assert mine.stages[-1].coefficients.toArray() == pytest.approx(theirs.coefficients.toArray(), abs=1e-5)
    assert mine.stages[-1].intercept == pytest.approx(theirs.intercept, abs=1e-5)
    # Not to as many rows as there are claims; those it was fitted to say nothing of the claims.
    assert not mine.stages[-1].hasSummary and theirs.hasSummary


def test_moments_are_those_of_the_claims(spark, claims):
    stages = features.fit_features(claims.where("label is not null"), "B")
    found = weights.vocabulary(stages)
    codes, at = [c for c, _ in found], [[-1 if f is None else f for f in fs] for _, fs in found]
    vectors = PipelineModel(stages).transform(claims.where("label is not null")).select("features", "label").collect()
    x = np.array([[1.0, *r["features"].toArray()] for r in vectors])
    y = np.array([r["label"] for r in vectors])
    moments = code_moments(claims, COLUMNS, codes, at)
    got = {(r["a"], r["b"]): r for r in moments.collect()}
    n, sums = x.T @ x, x.T @ (x * y[:, None])
    wanted = {(a - 1, b - 1) for a in range(len(n)) for b in range(a, len(n)) if n[a, b]}
    assert got.keys() == wanted and 0 < len(y) < 800
    for (a, b), r in got.items():
        assert r["n"] == n[a + 1, b + 1] and r["labels"] == pytest.approx(sums[a + 1, b + 1])
    assert got[-1, -1]["squares"] == pytest.approx(y @ y)
    rows = lasso.moment_rows(spark, moments, x.shape[1] - 1).collect()
    z = np.array([[*r["features"].toArray(), r["label"]] for r in rows])
    both = np.column_stack([x[:, 1:], y])
    assert z.mean(axis=0) == pytest.approx(both.mean(axis=0))
    assert np.cov(z.T, bias=True) == pytest.approx(np.cov(both.T, bias=True), abs=1e-6)
    assert lasso.moment_rows(spark, code_moments(claims.limit(0), COLUMNS, codes, at), 3) is None


def test_no_row_per_pair_of_codes_and_no_vector_per_claim(spark, claims, capsys):
    model = training.fit(claims, "B")
    table = weights.model_weights(spark, model)
    lasso.code_pairs(claims, table, COLUMNS).explain()
    training.score(model, claims).select("id", "prediction").explain()
    training.score_marked(model, claims).select("id", "scored", "prediction").explain()
    weights.score_by_weights(claims, table, COLUMNS).select("id", "prediction").explain()
    plan = capsys.readouterr().out
    assert "Generate" not in plan and "UDF(" not in plan and "Join" not in plan
    # Looked up once, also where claims without a prediction are left out.
    assert plan.count("ArrowEvalPython") == 3


def test_scores_are_those_of_the_pipeline(spark, claims):
    model = training.fit(claims, "B")
    frame = claims.unionByName(claims.limit(5).withColumn(COLUMNS[0], F.lit("never seen")).withColumn("id", -F.col("id") - 1))
    theirs = {r["id"]: r["prediction"] for r in model.transform(frame).select("id", "prediction").collect()}
    mine = {r["id"]: r["prediction"] for r in training.score(model, frame).collect()}
    marked = training.score_marked(model, frame).collect()
    assert mine.keys() == theirs.keys() == {r["id"] for r in marked if r["scored"]} and len(marked) == 805
    assert all(mine[i] == pytest.approx(theirs[i]) for i in mine)
    assert all((r["prediction"] is None) != r["scored"] for r in marked)
    # Any other pipeline is run as it is.
    kept = PipelineModel([s.copy({s.handleInvalid: "keep"}) if isinstance(s, StringIndexerModel) else s for s in model.stages[:-1]])
    assert training._predictor(kept) is None and training._predictor(PipelineModel([*kept.stages, model.stages[-1]])) is None


def test_larger_vocabularies_are_joined(spark, claims, monkeypatch, capsys):
    model = training.fit(claims, "B")
    table = materialise(weights.model_weights(spark, model), "weights")
    held = {r["id"]: (r["scored"], r["prediction"]) for r in weights.score_by_weights(claims, table, COLUMNS).collect()}
    monkeypatch.setattr(weights, "MOST_CODES", 10)
    monkeypatch.setattr(training, "MOST_CODES", 10)
    joined = weights.score_by_weights(claims, table, COLUMNS)
    joined.explain()
    assert "Join" in capsys.readouterr().out
    for r in joined.collect():
        assert held[r["id"]][0] == r["scored"] and held[r["id"]][1] == pytest.approx(r["prediction"])
    wide = training.fit(claims, "B")
    assert wide.stages[-1].hasSummary
    assert wide.stages[-1].coefficients.toArray() == pytest.approx(model.stages[-1].coefficients.toArray(), abs=1e-5)


def test_rows_are_not_sorted_to_write_folders(spark, tmp_path):
    def written():
        return materialise(spark.range(20).selectExpr("id", "cast(id % 3 as string) kind"), "sorted", ["kind"])

    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = written()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert sorted(r[:] for r in rows.collect()) == [(i, str(i % 3)) for i in range(20)]
    assert rows.where("kind = '1'").count() == 7
