"""Splits of exact size, profiles kept by day, staged and ordered tables, days in one job."""

import pytest
from pyspark.sql import functions as F

from billshift import fixed
from billshift.operators import effect, profiles, splits
from billshift.plans import incremental
from billshift.sources import readers, writers


@pytest.mark.parametrize("percent", [0, 37, 70, 100])
def test_split_sizes_are_exact(spark, percent):
    group = F.when(F.col("id") % 9 == 0, F.lit(None)).when(F.col("id") < 3, "tiny").otherwise("large")
    rows = spark.range(2000).select("id", group.alias("kind"), F.lit(1).alias("n"), F.lit(2).alias("_hash"))
    sides = {}
    for parts in (2, 7):
        train, rest = splits.exact_split(rows.repartition(parts), ["id"], ["kind"], percent)
        assert train.columns == rest.columns == rows.columns
        sides[parts] = {r["id"] for r in train.collect()}, {r["id"] for r in rest.collect()}
    assert sides[2] == sides[7] and not sides[2][0] & sides[2][1] and len(sides[2][0] | sides[2][1]) == 2000
    for kind, ids in rows.groupBy("kind").agg(F.collect_list("id")).collect():
        assert len(sides[2][0] & set(ids)) == len(ids) * percent // 100


def test_split_takes_the_smallest_hashes_of_all(spark):
    rows = spark.range(500).repartition(3)
    train, _ = splits.exact_split(rows, ["id"], train_percent=50)
    ordered = rows.select("id", splits.key_hash(["id"]).alias("h")).orderBy("h").limit(250)
    assert {r["id"] for r in train.collect()} == {r["id"] for r in ordered.collect()}


def test_rows_with_equal_keys_stay_together(spark):
    rows = spark.range(60).select((F.col("id") % 2).alias("k"), "id")
    train, rest = splits.exact_split(rows, ["k"], train_percent=70)
    assert {train.count(), rest.count()} == {60, 0}
    assert splits.exact_split(rows.limit(0), ["k"])[0].count() == 0


CLAIMS = f"{fixed.PROVIDER} long, {fixed.CLAIM_TYPE} string, period string, {fixed.AMOUNT} double, prediction double, scored boolean, part int"


@pytest.fixture(scope="module")
def claims(spark):
    rows = []
    for i in range(3000):
        provider = None if i % 211 == 0 else (1 if i % 3 else i % 17)  # one holds most claims
        amount = None if i % 97 == 0 else 1e6 + (i * 7919 % 1000)
        kind = ("A", "B", "DME", "X")[i % 4]
        rows.append((provider, kind, fixed.PERIODS[i * 13 % 5 > 1], amount, 1e6 + i % 10 if i % 11 else None, i % 11 != 0, i % 4))
    rows.append((99, "A", "before", 5.0, 1.0, True, 2))  # a single claim has no deviation
    return writers.materialise(spark.createDataFrame(rows, CLAIMS), "claims")


def same_profiles(a, b):
    a, b = (sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str) for df in (a, b))
    assert len(a) == len(b) > 0
    key = lambda r: str(r)
    for x, y in zip(sorted(a, key=key), sorted(b, key=key)):
        for u, v in zip(x, y):
            assert u == v or u == pytest.approx(v, rel=1e-9)


def test_merged_profiles_equal_the_profile_of_all(claims):
    whole = effect.provider_profile(claims, F.col("scored"))
    merged = effect.provider_profile(claims.where("part = 0"), F.col("scored"))
    for part in (1, 2, 3):
        merged = profiles.merge_profiles(merged, effect.provider_profile(claims.where(F.col("part") == part), F.col("scored")))
    order = [fixed.PROVIDER]
    same_profiles(whole.orderBy(*order), merged.orderBy(*order))
    empty = effect.provider_profile(claims.limit(0), F.col("scored"))
    same_profiles(whole, profiles.merge_profiles(empty, whole))


def test_days_in_any_order_and_again(spark, claims, tmp_path):
    root, scored = str(tmp_path), F.col("scored")
    days = {f"2001-01-0{p + 1}": claims.where(F.col("part") == p) for p in range(4)}
    for day in ("2001-01-04", "2001-01-01", "2001-01-03"):
        incremental.add_day(spark, root, day, days[day], scored)
    incremental.add_day(spark, root, "2001-01-02", days["2001-01-01"], scored)  # wrong claims first
    last = incremental.add_day(spark, root, "2001-01-02", days["2001-01-02"], scored)
    same_profiles(effect.provider_profile(claims, scored), last)
    early = spark.read.parquet(f"{root}/snapshots").where("run_date = date '2001-01-02'").drop("run_date")
    same_profiles(effect.provider_profile(claims.where("part < 2"), scored), early)
    empty = incremental.add_day(spark, root, "2001-01-05", claims.limit(0), scored)
    same_profiles(effect.provider_profile(claims, scored), empty)


def test_a_first_day_without_claims(spark, claims, tmp_path):
    assert incremental.add_day(spark, str(tmp_path), "2001-01-01", claims.limit(0), F.col("scored")).count() == 0


def test_a_failing_replacement_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        readers.read_current(spark, root)
    writers.replace_table(spark.range(3), root, "replaced_numbers")
    bad = spark.range(1000).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.replace_table(bad, root, "replaced_numbers")
    assert readers.read_current(spark, root).count() == 3 and spark.table("replaced_numbers").count() == 3
    reader = readers.read_current(spark, root)
    writers.replace_table(spark.range(5), root, "replaced_numbers")
    # Who began before goes on with the version before.
    assert reader.count() == 3 and spark.table("replaced_numbers").count() == 5
    writers.replace_table(spark.sql("SELECT 'x' AS name"), root, "replaced_numbers")
    assert spark.table("replaced_numbers").columns == ["name"] == readers.read_current(spark, root).columns
    # The current version and the one before: nothing of the failed write is left.
    assert len(list((tmp_path / "t" / "versions").iterdir())) == 2


def test_days_are_replaced_in_one_job(spark, tmp_path):
    path = str(tmp_path / "days")
    day = F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 10).cast("int"))
    rows = spark.range(100).select("id", day.alias("run_date"))
    writers.publish_days(rows.unionByName(spark.sql("SELECT 5L AS id, CAST(NULL AS DATE) AS run_date")), path)
    for _ in range(2):
        writers.publish_days(rows.where("day(run_date) < 3 and id < 50"), path, days=["2001-01-05", "2001-01-01"])
    counts = {str(r[0])[-2:]: r[1] for r in readers.read_table(spark, path).groupBy("run_date").count().collect()}
    assert counts == {"01": 5, "02": 5, **{f"{d:02d}": 10 for d in range(3, 11) if d != 5}}


def test_file_names_are_the_order(spark, tmp_path):
    path = str(tmp_path / "ordered")
    rows = spark.range(4000).select((F.col("id") * 1237 % 4000).alias("k"), F.lit("x").alias("pad"))
    writers.write_ordered(rows, path, [F.col("k").desc()], files=5)
    read = []
    files = readers.ordered_files(spark, path)
    for name in files:
        read += [r["k"] for r in spark.read.parquet(name).collect()]
    assert len(files) == 5 and read == list(range(3999, -1, -1))
    assert [r["k"] for r in readers.read_ordered(spark, path).collect()] == read
