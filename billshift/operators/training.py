"""Fitting, saving and evaluating the charge regression of one claim type."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billshift import fixed
from billshift.functions.split import split_bucket
from billshift.operators.coded import MOST_CODES, code_moments, predictor
from billshift.operators.features import feature_stages, fit_features, stage_columns
from billshift.operators.lasso import moment_rows
from billshift.operators.metrics import regression_metrics
from billshift.operators.weights import code_weights, indexed_columns, model_weights, vocabulary
from billshift.sources.readers import read_table
from billshift.sources.writers import materialise, save_pipeline, save_weights, write_table


def random_split(
    df: DataFrame,
    fractions: Sequence[float] = tuple(fixed.SPLIT_FRACTIONS),
    seed: int = fixed.SPLIT_SEED,
) -> list[DataFrame]:
    """Seeded split; the sides depend on the partitioning. See ``hash_split``."""
    return df.randomSplit(list(fractions), seed=seed)


def hash_split(
    df: DataFrame, keys: Sequence[str], train_percent: int = 70, portable: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split by key hash: the same rows on each side under any partitioning."""
    bucket = split_bucket(keys, portable)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def charge_regressor(
    aggregation_depth: int = 2, max_iter: int = fixed.MAX_ITER, tolerance: float = fixed.TOLERANCE
) -> LinearRegression:
    """Lasso regression of the label; raise the depth with the number of partitions.

    The default settings stop near the optimum; more iterations and a smaller tolerance
    reach it (see ``optimality``).
    """
    return LinearRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        tol=tolerance,
        regParam=fixed.REG_PARAM,
        elasticNetParam=fixed.ELASTIC_NET,
        aggregationDepth=aggregation_depth,
    )


def training_pipeline(kind: str) -> Pipeline:
    """The unfitted pipeline of one claim type."""
    return Pipeline(stages=[*feature_stages(kind), charge_regressor()])


def fit(
    df: DataFrame,
    kind: str,
    aggregation_depth: int = 2,
    regressor: LinearRegression | None = None,
    levels: DataFrame | None = None,
) -> PipelineModel:
    """Fit the pipeline of one claim type; claims without a label are left out.

    Where Spark ML solves normal equations, their moments are counted from the codes
    (``code_moments``) and the regression is fitted to rows that have the same
    (``moment_rows``), so it keeps no training summary. Otherwise it is fitted to a vector per claim:
    each task sends a buffer as large as the model's gradient, and ``aggregation_depth``
    merges them in steps. ``levels``: the vocabulary of
    the labelled claims (``code_levels``), if it has been counted already.
    """
    labelled = df.where(F.col("label").isNotNull())
    stages = fit_features(labelled, kind, levels)
    regressor = regressor or charge_regressor(aggregation_depth)
    rows = _same_moments(labelled, kind, stages, regressor)
    if rows is not None:
        fitted = regressor.fit(rows)
        # It would tell of those rows.
        fitted._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
        return PipelineModel([*stages, fitted])
    features = PipelineModel(stages).transform(labelled).select("features", "label")
    return PipelineModel([*stages, regressor.fit(features)])


def _same_moments(labelled: DataFrame, kind: str, stages: Sequence[Transformer], regressor: LinearRegression) -> DataFrame | None:
    """``moment_rows`` of the claims, if the regressor needs no more and a task can hold the codes."""
    plain = regressor.getLoss() == "squaredError" and regressor.getSolver() in ("auto", "normal") and not regressor.isSet("weightCol")
    if not plain or _codes(stages) > MOST_CODES:
        return None
    found = vocabulary(stages)
    codes, features = [c for c, _ in found], [[-1 if f is None else f for f in fs] for _, fs in found]
    size = 1 + max((f for fs in features for f in fs), default=-1)
    return moment_rows(labelled.sparkSession, code_moments(labelled, stage_columns(kind), codes, features), size)


def _codes(stages: Sequence[Transformer]) -> int:
    """How many codes the stages know, without bringing them to Python."""
    indexers = [s for s in stages if isinstance(s, StringIndexerModel)]
    return sum(len(labels) for s in indexers for labels in s._java_obj.labelsArray())


def _predictor(model: PipelineModel) -> Column | None:
    """The model's prediction as a sum of looked-up weights, null where it would skip the claim.

    None if the pipeline is not one of ``fit`` or knows more codes than a task should hold.
    """
    if len(model.stages) < 4:
        return None
    *indexers, encoder, assembled, regression = model.stages
    kinds = [StringIndexerModel] * len(indexers) + [OneHotEncoderModel, VectorAssembler, LinearRegressionModel]
    if not all(map(isinstance, model.stages, kinds)) or _codes(indexers) > MOST_CODES:
        return None
    outputs = [o for s in indexers for o in (s.getOutputCols() if s.isSet("outputCols") else [s.getOutputCol()])]
    in_order = [o for o in outputs if o in encoder.getInputCols()] == encoder.getInputCols()
    whole = in_order and encoder.getOutputCols() == assembled.getInputCols() and encoder.getDropLast()
    if not whole or any(s.getHandleInvalid() != "skip" for s in indexers) or regression.getPredictionCol() != "prediction":
        return None
    codes = [labels for labels, _ in vocabulary(model.stages)]
    return predictor(codes, code_weights(model), regression.intercept)(*indexed_columns(model))


def score(model: PipelineModel, df: DataFrame, by_stages: bool = False) -> DataFrame:
    """Add ``prediction``; rows with a null or unseen code drop out.

    ``by_stages``: by the model's own stages, in the JVM, even where weights can be looked up.
    """
    frame, prediction = df.drop("prediction"), None if by_stages else _predictor(model)
    if prediction is None:
        return model.transform(frame)
    return frame.withColumn("prediction", prediction).where(F.col("prediction").isNotNull())


def score_marked(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every claim, with ``scored``; ``prediction`` is null where a code is null or unseen.

    The indexers keep such codes at an index beyond their levels. Those claims pass the
    later stages with first levels instead, so one scan serves scored and skipped alike.
    """
    prediction = _predictor(model)
    if prediction is not None:
        frame = df.drop("prediction", "scored")
        looked_up = frame.withColumn("prediction", prediction)
        return looked_up.select(*frame.columns, F.col("prediction").isNotNull().alias("scored"), "prediction")
    indexers = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    frame, known, indexed = df.drop("prediction", "scored"), F.lit(True), []
    for stage in indexers:
        outputs = stage.getOutputCols() if stage.isSet("outputCols") else [stage.getOutputCol()]
        frame = stage.copy({stage.handleInvalid: "keep"}).transform(frame)
        for output, labels in zip(outputs, stage.labelsArray):
            known = known & (F.col(output) < len(labels))
        indexed += outputs
    frame = frame.withColumn("scored", known)
    frame = frame.withColumns({c: F.when(F.col("scored"), F.col(c)).otherwise(0.0) for c in indexed})
    for stage in model.stages:
        if not isinstance(stage, StringIndexerModel):
            frame = stage.transform(frame)
    return frame.withColumn("prediction", F.when(F.col("scored"), F.col("prediction")))


def holdout_predictions(model: PipelineModel, holdout: DataFrame) -> DataFrame:
    """``label, prediction`` of the hold-out claims the model can score."""
    return score(model, holdout).select("label", "prediction")


def evaluate(model: PipelineModel, holdout: DataFrame) -> DataFrame:
    return regression_metrics(holdout_predictions(model, holdout))


def evaluation_row(
    metrics: DataFrame, model_name: str, train_ts: str, train_seconds: float, train_size: int
) -> DataFrame:
    """The stored row. ``n_rows``: hold-out claims the model could score."""
    return metrics.select(
        F.lit(model_name).alias("model_name"),
        F.lit(fixed.ALGORITHM).alias("algorithm"),
        F.lit(train_ts).alias("train_ts"),
        F.lit(float(train_seconds)).alias("train_time"),
        F.lit(train_size).cast("bigint").alias("train_size"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
        "rmse",
        "mse",
        "r2",
        "mae",
    )


def as_published(evaluation: DataFrame) -> DataFrame:
    """Evaluation rows under the names older tables use."""
    return evaluation.select(*[F.col(c).alias(n) for c, n in fixed.PUBLISHED_EVALUATION.items()])


def train(
    df: DataFrame,
    kind: str,
    root: str,
    metrics_path: str,
    keys: Sequence[str] | None = None,
    model_name: str | None = None,
    portable: bool = False,
    stored: bool = False,
) -> PipelineModel:
    """Split, fit, save and evaluate one claim type; writes its evaluation row.

    The model is saved as a pipeline and as a table of weights.

    The hold-out predictions are stored beside it (``holdout_path``), and the row is
    computed from the stored table: whoever doubts a metric can compute it again.

    ``keys`` selects the key-hash split, otherwise the seeded one is used.
    ``train_time`` is wall-clock seconds of the fit. The prepared claims are read
    several times (vocabulary, regression, evaluation), so they are written once as
    a narrow table (``stored`` says that ``df`` is one already); that also fixes the
    partitions a seeded split depends on.
    """
    df = df if stored else materialise(df, f"training-{kind}")
    train_ts = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    learn, holdout = hash_split(df, keys, portable=portable) if keys else random_split(df)
    if keys:
        learn, holdout = learn.drop(*keys), holdout.drop(*keys)
    start = time.perf_counter()
    model = fit(learn, kind)
    seconds = time.perf_counter() - start
    save_pipeline(root, fixed.MODEL_FOLDERS[kind], model)
    save_weights(root, fixed.MODEL_FOLDERS[kind], model_weights(df.sparkSession, model))
    predictions = holdout_path(metrics_path)
    write_table(holdout_predictions(model, holdout), predictions)
    metrics = regression_metrics(read_table(df.sparkSession, predictions))
    row = evaluation_row(metrics, model_name or f"charge_{kind}", train_ts, seconds, learn.count())
    write_table(row, metrics_path)
    return model


def holdout_path(metrics_path: str) -> str:
    """Where ``train`` stores the hold-out predictions behind an evaluation row."""
    return f"{metrics_path.rstrip('/')}-holdout"
