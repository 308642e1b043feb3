"""The model as a table of weights, its optimum, and the certificate."""

import random

import numpy as np
import pytest
from compare import normalised, sql_rows
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators import features, lasso, metrics, optimality, training, weights
from billshift.registry import queries
from billshift.sources.writers import materialise

COLUMNS = features.stage_columns("B")


@pytest.fixture(scope="module")
def claims(spark):
    """Codes with nulls; one column is constant, and two say the same."""
    rng = random.Random(8)

    def row(i):
        codes = [f"c{rng.randint(0, 1 + j % 4)}" for j in range(len(COLUMNS))]
        codes[3], codes[7] = "same", codes[2]
        charge = 1000 * rng.random() + 700 * (codes[0] == "c1") - 300 * (codes[2] == "c2")
        if rng.random() < 0.1:
            codes[5] = None
        return (*codes, charge if i % 50 else None, i)

    schema = ", ".join(f"{c} string" for c in COLUMNS) + ", label double, id bigint"
    return materialise(spark.createDataFrame([row(i) for i in range(800)], schema), "claims")


@pytest.fixture(scope="module")
def model(claims):
    return training.fit(claims, "B")


@pytest.fixture(scope="module")
def table(spark, model):
    return materialise(weights.model_weights(spark, model), "weights", ["position"])


def test_weights_name_every_code_and_feature(model, table):
    rows = table.collect()
    size = len(model.stages[-1].coefficients)
    assert sorted(r["feature"] for r in rows if r["feature"] is not None) == list(range(size))
    assert weights.indexed_columns(model) == COLUMNS
    constant = [r for r in rows if r["position"] == 3]
    assert [(r["code"], r["feature"], r["weight"]) for r in constant] == [("same", None, 0.0)]
    assert weights.intercept_of(table) == model.stages[-1].intercept


def test_predictions_equal_the_pipeline(claims, model, table):
    odd = claims.limit(1).withColumns({COLUMNS[0]: F.lit("unseen"), "id": F.lit(-1).cast("bigint")})
    frame = claims.unionByName(odd).withColumn("prediction", F.lit(5.0)).withColumn("_code0", F.lit("x"))
    mine = weights.score_by_weights(frame, table, COLUMNS)
    assert set(mine.columns) == {*frame.columns, "scored"}
    rows = {r["id"]: r for r in mine.collect()}
    theirs = {r["id"]: r["prediction"] for r in training.score(model, frame).collect()}
    assert len(rows) == 801 and not rows[-1]["scored"] and rows[-1]["prediction"] is None
    assert {i for i, r in rows.items() if r["scored"]} == set(theirs)
    for i, prediction in theirs.items():
        assert rows[i]["prediction"] == pytest.approx(prediction, rel=1e-9)


def test_predictions_equal_the_pipeline_on_all_claims(spark, sf_dir):
    stored = queries._stored_claims(spark, sf_dir)
    learn = queries._stored_training(stored)
    for kind, columns in queries.KINDS.items():
        claims = queries.prep.training_of(learn, kind)
        fitted = training.fit(claims, kind)
        lookup = weights.model_weights(spark, fitted)
        both = training.score(fitted, weights.score_by_weights(claims, lookup, columns).withColumnRenamed("prediction", "mine"))
        apart = both.agg(F.max(F.abs(F.col("mine") - F.col("prediction"))), F.count_if("scored"), F.count("*")).first()
        assert apart[0] < 1e-6 and apart[1] == apart[2] > 0


def test_subgradients_by_hand(claims, table):
    scored = weights.score_by_weights(claims, table, COLUMNS)
    rows = scored.where("prediction is not null and label is not null").collect()
    n, total = len(rows), sum(r["label"] - r["prediction"] for r in rows)
    for g in optimality.subgradients(scored, table, COLUMNS).collect():
        here = [r["label"] - r["prediction"] for r in rows if r[COLUMNS[g["position"]]] == g["code"]]
        share = len(here) / n
        scale = np.sqrt(share * (1 - share) * n / (n - 1))
        slope = (sum(here) - share * total) / (n * scale)
        assert (g["n"], g["scale"]) == (len(here), pytest.approx(scale))
        assert g["slope"] == pytest.approx(slope, abs=1e-9)
        want = max(abs(slope) - 0.1, 0) if g["weight"] == 0 else abs(slope - 0.1 * np.sign(g["weight"]))
        assert g["violation"] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("penalty", [0.1, 20.0, 1e6])
def test_refined_weights_are_optimal(claims, table, penalty):
    best = materialise(lasso.refine(claims, table, COLUMNS, penalty), "refined")
    scored = weights.score_by_weights(claims, best, COLUMNS)
    gradients = optimality.subgradients(scored, best, COLUMNS, penalty)
    assert gradients.agg(F.max("violation")).first()[0] < 1e-6
    gap = optimality.duality_gap(scored, gradients, penalty).first()
    assert abs(gap["gap"]) < 1e-8 * gap["primal"] and gap["claims"] == scored.where("scored and label is not null").count()
    zero = best.where("feature is not null and weight = 0").count()
    assert zero == best.where("feature is not null").count() if penalty == 1e6 else zero < 20
    # The certificate tells a model that is off.
    off = best.withColumn("weight", F.when(F.col("feature") == 0, F.col("weight") + 50).otherwise(F.col("weight")))
    worse = weights.score_by_weights(claims, off, COLUMNS)
    assert optimality.subgradients(worse, off, COLUMNS, penalty).agg(F.max("violation")).first()[0] > 1
    assert optimality.duality_gap(worse, optimality.subgradients(worse, off, COLUMNS, penalty), penalty).first()["gap"] > 1


def test_sign_search_agrees_with_coordinate_descent():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 9))
    x[:, 8] = x[:, 0] + x[:, 1]  # depends on others
    y = x @ rng.normal(size=9) + rng.normal(size=60)
    spread, along, penalty = x.T @ x / 60, x.T @ y / 60, np.full(9, 0.3)
    slow = np.zeros(9)
    for _ in range(20000):
        for j in range(9):
            rest = along[j] - spread[j] @ slow + spread[j, j] * slow[j]
            slow[j] = np.sign(rest) * max(abs(rest) - penalty[j], 0) / spread[j, j]
    loss = lambda w: w @ spread @ w / 2 - along @ w + penalty @ abs(w)
    for start in (np.zeros(9), rng.normal(size=9)):
        assert loss(lasso.feature_signs(spread, along, penalty, start)) <= loss(slow) + 1e-10


def test_stored_predictions_give_the_evaluation_row(spark, claims, tmp_path):
    path = str(tmp_path / "evaluation")
    training.train(claims, "B", str(tmp_path), path, keys=["id"])
    row = spark.read.parquet(path).first()
    stored = training.holdout_path(path)
    names, rows = sql_rows(
        "/nowhere",
        f"""SELECT count(*) AS n_rows, sqrt(avg((prediction - label) ** 2)) AS rmse, avg((prediction - label) ** 2) AS mse,
            1 - sum((prediction - label) ** 2) / (count(*) * var_pop(label)) AS r2, avg(abs(prediction - label)) AS mae
            FROM '{stored}/*.parquet' WHERE label IS NOT NULL""",
    )
    assert normalised(names, rows)[1] and rows[0][0] == row["n_rows"]
    for name, value in zip(names, rows[0]):
        assert row[name] == pytest.approx(value)
    assert row["train_time"] > 0 and row["train_ts"] and row["algorithm"] == fixed.ALGORITHM
    assert metrics.regression_metrics(spark.read.parquet(stored)).first()["n_rows"] == row["n_rows"]


def test_vocabularies_are_never_one_row(spark, claims, capsys):
    levels = features.code_levels(claims, COLUMNS)
    levels.orderBy(*features._level_order()).explain()
    features.ranked_levels(levels).explain()
    plan = capsys.readouterr().out
    assert "collect_list" not in plan and "SinglePartition" not in plan and "rangepartitioning" in plan


def test_a_million_codes(spark):
    codes = spark.range(1_000_000).select(
        F.lit(0).alias("position"), F.concat(F.lit("c"), F.col("id")).alias("code"), (F.col("id") % 7).alias("n_rows")
    )
    more = spark.createDataFrame([(1, "b", 1), (1, "a", 1), (1, "z", 5)], "position int, code string, n_rows long")
    arrays = features.label_arrays(codes.unionByName(more), 3)
    assert [len(a) for a in arrays] == [1_000_000, 3, 0]
    assert (arrays[0][0], arrays[0][999_999]) == ("c1000", "c999999") and list(arrays[1]) == ["z", "a", "b"]
    ranked = features.ranked_levels(codes)
    best = ranked.where("level in (0, 999999)").orderBy("level").collect()
    assert [r["code"] for r in best] == ["c1000", "c999999"]
    assert ranked.agg(F.count_distinct("level"), F.max("level")).first()[:] == (1_000_000, 999_999)
