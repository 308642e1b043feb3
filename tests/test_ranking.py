"""Numbering rows across partitions."""

from pyspark.sql import functions as F

from billshift.functions.names import unused
from billshift.operators.ranking import numbered


def test_numbers_follow_the_order(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("_place"))
    rows = numbered(frame, ["k"], "n", start=1).collect()
    assert len(rows) == 5000 and all(r["n"] == r["k"] + 1 for r in rows)
    assert rows[0].asDict().keys() == {"k", "_place", "n"}


def test_groups_count_for_themselves(spark):
    # One group holds almost all rows; a null group is a group.
    group = F.when(F.col("id") % 50 == 0, F.lit("b")).when(F.col("id") % 77 != 0, F.lit("a"))
    frame = spark.range(3000).select(group.alias("g"), "id")
    rows = numbered(frame, ["g", F.col("id").desc()], within=["g"]).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["g"], []).append((r["rank"], r["id"]))
    assert set(groups) == {"a", "b", None}
    for members in groups.values():
        assert [i for _, i in sorted(members)] == sorted((i for _, i in members), reverse=True)
        assert sorted(n for n, _ in members) == list(range(len(members)))


def test_ties_and_empty_tables(spark):
    tied = numbered(spark.range(100).select(F.lit(1).alias("k")), ["k"])
    assert sorted(r["rank"] for r in tied.collect()) == list(range(100))
    assert numbered(spark.range(0), ["id"]).count() == 0


def test_unused_names():
    assert unused(["A", "_x"], "_X") == "_X_" and unused([], "_x") == "_x"
