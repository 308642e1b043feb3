"""Sources and sinks."""

from pathlib import Path

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer

from billshift.operators.training import training_pipeline
from billshift.sources import readers, writers


def test_query_from_catalog_and_from_files(spark, sf_dir, tmp_path):
    df = readers.read_query(spark, f"SELECT n_name FROM parquet.`{sf_dir}/nation.parquet` WHERE n_nationkey = 3")
    assert [r[0] for r in df.collect()] == ["NATION_3"]
    writers.write_table(df, str(tmp_path / "t"))
    assert readers.read_table(spark, str(tmp_path / "t")).count() == 1


def test_connector_queries_pass_the_text_through(spark):
    with pytest.raises(Exception, match="no_such_connector"):
        readers.read_query(spark, "SELECT 1", "no_such_connector", {"url": "x"})


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "t", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    ranged = readers.jdbc_options("jdbc:x", "t", partition_column="id", bounds=(0, 9), partitions=3)
    assert ranged["numPartitions"] == "3" and ranged["upperBound"] == "9"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")


def test_registry_read_pushes_the_model_filter(spark, tmp_path, capsys):
    rows = spark.createDataFrame([("m1", "a"), ("m2", "b")], "MODEL_BUSNS_ID string, CONFIG_FLD string")
    writers.write_table(rows, str(tmp_path / "r"))
    df = readers.read_registry(spark, "m2", "parquet", {"path": str(tmp_path / "r")})
    assert [r["CONFIG_FLD"] for r in df.collect()] == ["b"]
    df.explain()
    assert "EqualTo(MODEL_BUSNS_ID,m2)" in capsys.readouterr().out


def test_overwrite_may_change_the_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(3), path)
    writers.write_table(spark.sql("SELECT 'x' AS name"), path, replace_schema=True)
    assert readers.read_table(spark, path).columns == ["name"]


def test_register_replaces_the_catalog_entry(spark, tmp_path):
    for n in (2, 5):
        path = str(tmp_path / f"t{n}")
        writers.write_table(spark.range(n), path)
        assert writers.register_table(spark, "registered_numbers", path).count() == n
    assert readers.read_catalog(spark, "registered_numbers").count() == 5


def test_increment_replaces_its_own_day_only(spark, tmp_path):
    path = str(tmp_path / "days")
    first = spark.sql("SELECT id, date '2001-12-30' AS run_date FROM range(4)")
    second = spark.sql("SELECT id, date '2001-12-31' AS run_date FROM range(7)")
    writers.publish_increment(first, path, "2001-12-30")
    for _ in range(2):
        writers.publish_increment(second, path, "2001-12-31")
    table = readers.read_table(spark, path)
    assert dict(table.dtypes)["run_date"] == "date"
    counts = {str(r[0]): r[1] for r in table.groupBy("run_date").count().collect()}
    assert counts == {"2001-12-30": 4, "2001-12-31": 7}
    writers.publish_increment(second.limit(0), path, "2001-12-31")
    assert readers.read_table(spark, path).count() == 4


def test_named_tables(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS results_db")
    assert writers.persist_df(spark.range(2), "  My_Table ") == "my_table"
    assert writers.persist_df(spark.range(3), "Other ", " RESULTS_DB ") == "results_db.other"
    assert spark.table("results_db.other").count() == 3
    for n in (4, 1):
        name = writers.send(spark.range(n), "m1", "ReportCard", "results_db")
        assert name == "results_db.m1_reportcard"
        assert spark.table(name).count() == n
    with pytest.raises(ValueError):
        writers.send(spark.range(1), "m1", "somewhere", "results_db")


def test_pipelines_go_to_their_folders(spark, tmp_path):
    root = str(tmp_path)
    fitted = PipelineModel([SQLTransformer(statement="SELECT *, id + 1 AS next FROM __THIS__")])
    assert writers.save_pipeline(root, "m", fitted).endswith("/m/trainedpipeline")
    assert writers.save_pipeline(root, "m", training_pipeline("A")).endswith("/m/pipeline")
    assert readers.load_pipeline(root, "m").transform(spark.range(1)).first()["next"] == 1
    assert isinstance(readers.load_pipeline(root, "m", "Pipeline"), Pipeline)
    with pytest.raises(ValueError):
        readers.load_pipeline(root, "m", "forest")
    with pytest.raises(Exception):
        readers.load_pipeline(root, "absent")


def test_materialised_tables_live_in_the_shared_folder(spark):
    df = writers.materialise(spark.range(5), "five")
    assert df.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_lake_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writers.write_table(spark.range(4), path, fmt)
    assert readers.read_table(spark, path, fmt).agg({"id": "sum"}).first()[0] == 6


def test_connector_writes_pass_options_and_mode(spark, tmp_path):
    """Any format stands in for a connector: the options name the place."""
    appended = {"path": str(tmp_path / "appended")}
    for _ in range(2):
        writers.append_increment(spark.range(3), "increments", "parquet", appended)
    assert spark.read.parquet(appended["path"]).count() == 6
    replaced = {"path": str(tmp_path / "replaced")}
    for _ in range(2):
        assert writers.persist_df(spark.range(3), " T ", "S", "parquet", replaced) == "s.t"
        writers.send(spark.range(5), "m1", "npisuspect", "s", "parquet", replaced)
    assert spark.read.parquet(replaced["path"]).count() == 5


def test_scratch_folder_is_named_by_the_session_and_can_be_cleared(spark):
    table = writers.materialise(spark.range(3), "numbers")
    folder = Path(writers.shared_folder(spark))
    assert table.count() == 3 and any(folder.iterdir())
    writers.clear_scratch(spark)
    assert not folder.exists()


def test_unset_scratch_folder_is_an_error():
    class Unset:
        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        writers.shared_folder(Unset)
