"""Reading tables, queries and fitted models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billshift import fixed


def read_query(
    spark: SparkSession,
    query: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of a query: in the catalog, or pushed to any installed connector.

    Name the needed columns in ``query``: a connector runs it as it stands, so
    Spark cannot prune ``SELECT *`` there.
    """
    if fmt is None:
        return spark.sql(query)
    return spark.read.format(fmt).options(**dict(options or {})).option("query", query).load()


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A lake table by path."""
    return spark.read.format(fmt).load(path)


#: Below a replaced table: the file that names the current version, and the versions' folder.
CURRENT = "_current"
VERSIONS = "versions"


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the version that ``writers.replace_table`` made current last; none before the first."""
    jvm = spark.sparkContext._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{CURRENT}")
    fs = pointer.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return f"{root.rstrip('/')}/{VERSIONS}/{name}"


def read_current(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a table written by ``writers.replace_table``."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version was ever completed under {root}")
    return spark.read.format(fmt).load(version)


def ordered_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a table, by name: the order of one written by ``writers.write_ordered``."""
    return sorted(spark.read.parquet(path).inputFiles(), key=lambda f: f.rsplit("/", 1)[1])


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``writers.write_ordered`` in the order it was written in.

    Spark reads files in any order; their names and the rows' places in them bring it back.
    """
    place = (F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    return spark.read.parquet(path).orderBy(*place)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name."""
    return spark.table(name)


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column it runs as parallel range scans."""
    options = {"url": url, "dbtable": table}
    optional = {"user": user, "password": password, "driver": driver}
    options.update({k: v for k, v in optional.items() if v is not None})
    if partition_column is not None:
        if bounds is None or partitions is None:
            raise ValueError("a partition column needs bounds and a partition count")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_registry(
    spark: SparkSession,
    model_id: str,
    fmt: str = "jdbc",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of one model in a config or registry table; the source gets the filter."""
    table = spark.read.format(fmt).options(**dict(options or {})).load()
    return table.where(F.col(fixed.CONFIG_MODEL) == model_id)


def pipeline_path(root: str, model_id: str, fitted: bool) -> str:
    folder = fixed.FITTED_FOLDER if fitted else fixed.UNFITTED_FOLDER
    return f"{root.rstrip('/')}/{model_id}/{folder}"


def weights_path(root: str, model_id: str) -> str:
    return f"{root.rstrip('/')}/{model_id}/{fixed.WEIGHTS_FOLDER}"


def load_weights(spark: SparkSession, root: str, model_id: str) -> DataFrame:
    """The weights table that ``writers.save_weights`` stored for a model."""
    return spark.read.parquet(weights_path(root, model_id))


def load_pipeline(root: str, model_id: str, kind: str = "pipelinemodel"):
    """A saved ``pipelinemodel`` (fitted) or ``pipeline`` (unfitted)."""
    kinds = {"pipelinemodel": (PipelineModel, True), "pipeline": (Pipeline, False)}
    if kind.lower() not in kinds:
        raise ValueError(f"kind must be one of {sorted(kinds)}, not {kind!r}")
    loader, fitted = kinds[kind.lower()]
    return loader.load(pipeline_path(root, model_id, fitted))
