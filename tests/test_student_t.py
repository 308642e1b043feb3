"""The t distribution against closed forms and an independent integration."""

import math

import pytest
from pyspark.sql import functions as F

from billshift.functions.student_t import log_gamma_half_step, t_two_sided


def p_values(spark, pairs):
    df = spark.createDataFrame([(float(t), float(v)) for t, v in pairs], "t double, v double")
    return [r[0] for r in df.select(t_two_sided(F.col("t"), F.col("v"))).collect()]


def even_exact(t, v):
    """Finite series for an even number of degrees of freedom."""
    sin = t / math.sqrt(v + t * t)
    cos2 = v / (v + t * t)
    term, total = 1.0, 1.0
    for j in range(1, v // 2):
        term *= (2 * j - 1) / (2 * j) * cos2
        total += term
    return 1 - sin * total


@pytest.mark.parametrize("t", [0.0, 0.3, 1.0, 2.5, 40.0, 5000.0])
def test_one_and_two_degrees(spark, t):
    one, two = p_values(spark, [(t, 1), (t, 2)])
    assert one == pytest.approx(2 / math.pi * math.atan2(1, t), rel=1e-10)
    root = math.sqrt(2 + t * t)
    assert two == pytest.approx(2 / (root * (root + t)), rel=1e-10)


@pytest.mark.parametrize("v", [4, 10, 50, 98, 600])
def test_even_degrees(spark, v):
    points = [0.0, 0.5, 1.0, 1.98, 2.7, 3.5]
    for t, got in zip(points, p_values(spark, [(t, v) for t in points])):
        assert got == pytest.approx(even_exact(t, v), abs=1e-11)


def test_normal_limit_keeps_digits_far_in_the_tail(spark):
    for t in (1.0, 5.0, 12.0, 30.0):
        (got,) = p_values(spark, [(t, 1e12)])
        assert got == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-6)


def test_known_values(spark):
    got = p_values(spark, [(2.0, 49.5), (1.98, 98), (4, 300.2)])
    assert got == pytest.approx([0.0510025, 0.0505079, 7.9828e-05], rel=1e-5)


def test_sign_does_not_matter_and_extremes(spark):
    left, right, far, nan = p_values(
        spark, [(-2.2, 61), (2.2, 61), (math.inf, 10), (math.nan, 10)]
    )
    assert left == right
    assert far == 0.0
    assert math.isnan(nan)


def test_null_stays_null(spark):
    df = spark.sql("SELECT cast(null AS double) AS t, 5D AS v")
    assert df.select(t_two_sided(F.col("t"), F.col("v"))).first()[0] is None


def test_gamma_ratio(spark):
    xs = [0.5, 1.0, 3.25, 24.5, 1000.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, (got,) in zip(xs, df.select(log_gamma_half_step(F.col("x"))).collect()):
        assert got == pytest.approx(math.lgamma(x + 0.5) - math.lgamma(x), abs=1e-11)
