"""Split windows must equal plain windows, whatever the cut."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelake.operators.quantiles import exact_quantiles, grouped_quantile
from tidelake.operators.split_window import BLOCK, SplitWindow


def frame(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot", "hot", "hot", "cold", None]), rng.choice([None, *range(60)]),
             rng.choice([None, *range(9)])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k string, o int, v int")


@pytest.mark.parametrize("keys,hot_rows", [(["k"], 10), (["k"], 60), (["k"], 10**9), ([], 80), ([], 10**9)])
def test_equals_plain_window(spark, keys, hot_rows):
    df = frame(spark)
    w = SplitWindow(df, keys, "o", ["id"], hot_rows=hot_rows)
    out = (w.total("total", F.col("v")).position("pos").rank("rnk").last_seen("ff", F.col("v")).next_seen("bf", F.col("v"))
           .previous("lag", F.col("v")).following("lead", F.col("v")).result())
    base = Window.partitionBy(*keys)
    order = base.orderBy(F.col("o").asc_nulls_first(), F.col("id"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum("v").over(upto).alias("total"), F.row_number().over(order).cast("long").alias("pos"),
                     F.rank().over(base.orderBy(F.col("o").asc_nulls_first())).cast("long").alias("rnk"),
                     F.last("v", True).over(upto).alias("ff"),
                     F.first("v", True).over(order.rowsBetween(0, Window.unboundedFollowing)).alias("bf"),
                     F.lag("v").over(order).alias("lag"), F.lead("v").over(order).alias("lead"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("order", [
    "id", "'one day'", "CAST(NULL AS INT)", "format_string('Customer#%015d', id)",
    "CASE WHEN id = 0 THEN 'Aaron' ELSE format_string('Customer#%015d', id) END"])
def test_blocks_are_even_whatever_the_order(spark, order):
    df = spark.range(20_000).withColumn("o", F.expr(order)).withColumn("k", F.lit("hot"))
    w = SplitWindow(df, ["k"], "o", ["id"], hot_rows=2500)
    sizes = [r["count"] for r in w.cut.groupBy(BLOCK).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 5000
    got = w.position("n").result().agg(F.sum("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(got) == (20_000 * 20_001 // 2, 20_000, 20_000)


def test_every_hot_key_is_split(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 1500).alias("k"))
    w = SplitWindow(df, ["k"], "id", hot_rows=10).position("n")
    assert w.cold.count() == 0 and w.hot[0].count() == 1500
    assert w.result().agg(F.max("n"), F.sum("n")).first()[:] == (20, 1500 * 210)


@pytest.mark.parametrize("sorted_rows", [5, 100_000])
@pytest.mark.parametrize("data", [
    [1.0, 2.0, 3.0, 4.0], [5.0] * 50, [1.0] * 90 + [2.0, 3.0, 1e9], [None, 1.0, None, 7.0], [3.0],
    [10.0 ** e for e in range(-30, 300, 3)], [float(i * i % 101) for i in range(997)], [-1e308, 1e308] + [0.1 * i for i in range(40)]])
def test_exact_quantiles(spark, data, sorted_rows):
    import numpy as np
    df = spark.createDataFrame([(x,) for x in data], "x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, {"x": F.col("x")}, {"x": probs}, sorted_rows=sorted_rows)["x"]
    clean = np.array([x for x in data if x is not None])
    for p in probs:
        at = p * (len(clean) - 1)
        lo, hi = np.sort(clean)[int(np.floor(at))], np.sort(clean)[int(np.ceil(at))]
        assert got[p] == pytest.approx(lo + (hi - lo) * (at - np.floor(at)), rel=1e-12), p


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, {"x": F.col("x")}, {"x": [0.5]}) == {"x": {0.5: None}}


def test_grouped_quantile_ways_agree(spark):
    df = frame(spark)
    few = grouped_quantile(df, ["k"], F.col("o"), {"p": 0.95, "m": 0.5}).collect()
    spark.conf.set("tidelake.window.hotRows", "20")
    try:
        many = grouped_quantile(df, ["k"], F.col("o"), {"p": 0.95, "m": 0.5}, max_distinct=0).collect()
    finally:
        spark.conf.unset("tidelake.window.hotRows")
    few, many = ({r["k"]: (round(r["p"], 9), round(r["m"], 9)) for r in rows} for rows in (few, many))
    assert few == many and set(few) == {"hot", "cold", None}


def test_grouped_quantile_has_one_way(spark):
    """The formula does not depend on the number of values: no group goes through percentile()."""
    plan = grouped_quantile(frame(spark), ["k"], F.col("o"), {"p": 0.95})._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower()


def test_plain_windows_are_cut_by_rows(spark, monkeypatch):
    """Rows of few bytes are not packed into one task of very many rows: tasks follow from the count of rows."""
    from tidelake.operators import split_window as S
    rows = spark.range(3000).select((F.col("id") % 100).alias("k"), "id")
    before = SplitWindow(rows, ["k"], "id").position("n").result()
    monkeypatch.setattr(S, "TASK_ROWS", 50)
    cut = SplitWindow(rows, ["k"], "id").position("n").result()
    assert cut.rdd.getNumPartitions() >= 60 > before.rdd.getNumPartitions()
    assert sorted(cut.collect()) == sorted(before.collect())
    later = SplitWindow(cut, ["k"], "id", hot=(None, 0)).following("next", F.col("id")).result()
    assert later._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
