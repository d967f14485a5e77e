"""Quantiles of distributions against the standard library and published values."""

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tidelake.functions.distributions import normal_quantile, student_quantile


def test_normal_quantile(spark):
    p = [1e-300, 1e-12, 1e-5, 0.02, 0.074, 0.076, 0.5, 0.9, 0.95, 0.975, 0.999999]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").select(normal_quantile(F.col("p"))).collect()]
    for x, z in zip(p, got):
        assert z == pytest.approx(NormalDist().inv_cdf(x), rel=1e-12, abs=1e-15)
    out = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (None,)], "p double").select(normal_quantile(F.col("p"))).collect()
    assert [r[0] for r in out] == [None] * 4


# Two-sided published quantiles of Student's t.
PUBLISHED = [(1, 0.1, 6.3138), (1, 0.01, 63.657), (2, 0.05, 4.3027), (3, 0.05, 3.1824), (10, 0.05, 2.2281), (10, 0.001, 4.5869), (30, 0.05, 2.0423),
             (100, 0.01, 2.6259), (200, 0.05, 1.9719), (500, 0.05, 1.9647), (1000, 0.01, 2.5808)]


def test_student_quantile(spark):
    df = spark.createDataFrame([(n, p) for n, p, _ in PUBLISHED], "n int, p double")
    got = [r[0] for r in df.select(student_quantile(F.col("n"), F.col("p"))).collect()]
    for (n, p, want), t in zip(PUBLISHED, got):
        assert t == pytest.approx(want, rel=2e-5), n
    assert got[0] == pytest.approx(math.tan(math.pi / 2 * 0.9), rel=1e-12)
    none = spark.createDataFrame([(0, 0.5), (5, 0.0), (5, 1.0), (None, 0.5), (5, None)], "n int, p double")
    assert [r[0] for r in none.select(student_quantile(F.col("n"), F.col("p"))).collect()] == [None] * 5


def test_expressions_stay_short(spark):
    plan = spark.range(1).select(student_quantile(F.col("id") + 3, F.lit(0.05)))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 40_000 and "Python" not in plan
