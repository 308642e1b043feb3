"""How claims are joined with the tables that carry their codes."""

from billshift import fixed
from billshift.sources import star, writers


def test_codes_are_made_before_the_join(spark, sf_dir):
    claims = star.claims(spark, sf_dir, codes=[fixed.NUMBERED_PROCEDURES[1], fixed.DIAGNOSES[4]])
    plan = claims._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[: plan.index("Join")]
    assert "p_name" not in joined and "split_part" not in joined


def test_hashed_joins_end_with_the_block(spark):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    with writers.hashed_joins(spark, "1m"):
        assert spark.conf.get(name) == "1m"
    assert spark.conf.get(name) == before
