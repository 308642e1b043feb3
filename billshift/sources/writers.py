"""Writing tables, dated increments and models."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift import fixed
from billshift.sources.readers import CURRENT, VERSIONS, pipeline_path, weights_path

_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    replace_schema: bool = False,
) -> None:
    """Write a lake table; ``replace_schema`` lets a table format change its columns."""
    writer = df.write.format(fmt).mode(mode)
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Replace the catalog entry ``name`` by an external table over ``path``.

    A dated table gets all its days.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    table = spark.catalog.createTable(name, path=path, source=fmt)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return table


def publish_increment(df: DataFrame, path: str, run_date: str, date_col: str = "run_date") -> None:
    """Write one day of a dated parquet table, replacing that day only.

    A rerun, also one that yields no rows, leaves exactly its own result for the
    day, so a job restarted after lost executors publishes nothing twice.
    """
    day = f"{path.rstrip('/')}/{date_col}={date.fromisoformat(run_date).isoformat()}"
    df.drop(date_col).write.mode("overwrite").parquet(day)


def publish_days(df: DataFrame, path: str, date_col: str = "run_date", days: Sequence[str] = ()) -> None:
    """Write many days of a dated parquet table in one job, replacing those days only.

    ``df`` has the day in ``date_col``; days it has rows of are replaced by dynamic partition
    overwrite, so a rerun leaves what one run leaves. Of ``days``, those without rows become
    empty. Rows are brought together by day first, a large day over several tasks, so that
    tasks do not write a file for every day.
    """
    day = F.col(date_col).cast("date")
    stored = materialise(df.where(day.isNotNull()).withColumn(date_col, day), "days")
    # Splits the large days by themselves; the sizes come from the exchange.
    dealt = stored.hint("rebalance", date_col)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)
    wanted = {date.fromisoformat(d) for d in days}
    found = {r[0] for r in stored.where(F.col(date_col).isin(list(wanted))).select(date_col).distinct().collect()} if wanted else set()
    for missing in sorted(wanted - found):
        publish_increment(df.limit(0), path, missing.isoformat(), date_col)


def write_ordered(df: DataFrame, path: str, order: Sequence[Column | str], files: int | None = None) -> None:
    """Write a parquet table whose files, by name, and the rows in them stand in ``order``.

    Rows are split by ranges of the order, as many as ``files`` or else by size, and each task sorts
    and writes one range: nothing is merged. ``readers.read_ordered`` gives the order back.
    """
    ranged = df.repartitionByRange(*([files] if files else []), *order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def replace_table(
    df: DataFrame, root: str, name: str | None = None, fmt: str = "parquet", keep: int = 1
) -> str:
    """Replace a table, columns included, so that readers see the old rows or the new ones.

    The rows go to a folder of their own below ``root``; once they are all written, one rename
    of a small pointer file makes it the current version, and the catalog entry ``name`` is
    pointed at it. A write that fails midway leaves the old version current; its folder
    is deleted by the next replacement. ``keep`` versions before the current one stay
    for readers that have begun. One writer at a time. Returns the version's path; ``readers.read_current`` reads it.
    """
    spark = df.sparkSession
    version = f"{root.rstrip('/')}/{VERSIONS}/{_next_version(spark, root)}"
    df.write.format(fmt).mode("error").save(version)
    _point(spark, root, version)
    if name is not None:
        _switch(spark, name, version, fmt)
    _drop_versions(spark, root, version, keep)
    return version


def _files(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _version_names(spark: SparkSession, root: str) -> list[str]:
    folder, fs = _files(spark, f"{root.rstrip('/')}/{VERSIONS}")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _next_version(spark: SparkSession, root: str) -> str:
    """Numbered, so versions sort by age, and unique, so two writers never share a folder."""
    last = max((int(n.split("-")[0]) for n in _version_names(spark, root)), default=0)
    return f"{last + 1:09d}-{uuid.uuid4().hex}"


def _point(spark: SparkSession, root: str, version: str) -> None:
    jvm = spark.sparkContext._jvm
    staged, fs = _files(spark, f"{root.rstrip('/')}/{CURRENT}-{uuid.uuid4().hex}")
    final, _ = _files(spark, f"{root.rstrip('/')}/{CURRENT}")
    stream = fs.create(staged, True)
    stream.write(bytearray(version.rsplit("/", 1)[1].encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(staged, final, options)


def _switch(spark: SparkSession, name: str, version: str, fmt: str) -> None:
    """One catalog change where the columns stay, otherwise a new entry."""
    columns = spark.read.format(fmt).load(version).dtypes
    if spark.catalog.tableExists(name) and spark.table(name).dtypes == columns:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        register_table(spark, name, version, fmt)


def _drop_versions(spark: SparkSession, root: str, current: str, keep: int) -> None:
    """Versions before the last ``keep`` complete ones, and what failed writes have left."""
    older = [n for n in _version_names(spark, root) if n < current.rsplit("/", 1)[1]]
    paths = {n: f"{root.rstrip('/')}/{VERSIONS}/{n}" for n in older}

    def complete(name: str) -> bool:
        marker, fs = _files(spark, f"{paths[name]}/_SUCCESS")
        return fs.exists(marker)

    kept = [n for n in older if complete(n)][-keep:] if keep else []
    for name in set(older) - set(kept):
        folder, fs = _files(spark, paths[name])
        fs.delete(folder, True)


def append_increment(
    df: DataFrame, table: str, fmt: str, options: Mapping[str, str] | None = None
) -> None:
    """Append to a table behind a connector. Not idempotent; prefer publish_increment."""
    df.write.format(fmt).options(**dict(options or {})).option("dbtable", table).mode(
        "append"
    ).save()


def persist_df(
    df: DataFrame,
    table: str,
    schema: str | None = None,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> str:
    """Overwrite a named table (names trimmed, lower case); returns the name used.

    Without ``fmt`` it is a catalog table, otherwise it goes through the connector.
    """
    name = table.strip().lower()
    if schema is not None:
        name = f"{schema.strip().lower()}.{name}"
    if fmt is None:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.write.format(fmt).options(**dict(options or {})).option("dbtable", name).mode(
            "overwrite"
        ).save()
    return name


def result_table(model_id: str, suffix: str, schema: str) -> str:
    """``{schema}.{model}_{suffix}``; the suffix must be a known result suffix."""
    suffix = suffix.lower()
    if suffix not in fixed.RESULT_SUFFIXES:
        raise ValueError(f"table suffix {suffix!r} is not one of {fixed.RESULT_SUFFIXES}")
    return f"{schema}.{model_id}_{suffix}"


def send(
    df: DataFrame,
    model_id: str,
    suffix: str,
    schema: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> str:
    """Overwrite a model's result table; returns its name."""
    name = result_table(model_id, suffix, schema)
    if fmt is None:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.write.format(fmt).options(**dict(options or {})).option("dbtable", name).mode(
            "overwrite"
        ).save()
    return name


def save_pipeline(root: str, model_id: str, pipeline: Pipeline | PipelineModel) -> str:
    """Save a fitted or unfitted pipeline under the model's folder; returns the path."""
    path = pipeline_path(root, model_id, isinstance(pipeline, PipelineModel))
    pipeline.write().overwrite().save(path)
    return path


def save_weights(root: str, model_id: str, weights: DataFrame) -> str:
    """Store a model's weights table beside its pipeline, a folder per position; returns the path."""
    path = weights_path(root, model_id)
    weights.write.mode("overwrite").partitionBy("position").parquet(path)
    return path


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder the cluster names in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{folder.rstrip('/')}/billshift-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application wrote to the shared folder.

    Frames built on it can no longer be read: call it once their results are stored.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def hashed_joins(spark: SparkSession, most: str = "64m") -> Iterator[None]:
    """Within it, Spark need not sort both sides of a join where no partition of the smaller one, as measured, is over ``most``."""
    before = spark.conf.get(_HASHED)
    spark.conf.set(_HASHED, most)
    try:
        yield
    finally:
        spark.conf.set(_HASHED, before)


def materialise(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor, and gives the planner
    its true size for the joins that follow. ``by``: columns of few values, none of them
    null or empty, whose values get folders of their own, so that filters on them read
    nothing else.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_OPEN_FILES)
    # A task with a file open for each value need not sort its rows by them.
    if by and int(before) == 0:
        spark.conf.set(_OPEN_FILES, "16")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(_OPEN_FILES, before)
    stored = spark.read.schema(df.schema).parquet(path)
    return stored.select(*df.columns) if by else stored
