"""Keys that last, facts by period, snapshot facts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake.plans import star as S


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_keys_last_and_never_return(spark, tmp_path):
    registry = S.KeyRegistry(spark, str(tmp_path / "k"), ["a", "b"], "key")
    frame = lambda *r: spark.createDataFrame(list(r), "a string, b int")
    assert rows(registry.register(frame(("x", 1), ("x", 1), ("y", 2), (None, 3), ("z", None)))) == [("x", 1, 1), ("y", 2, 2)]
    assert rows(registry.register(frame(("a", 1), ("x", 1)))) == [("a", 1, 3), ("x", 1, 1), ("y", 2, 2)]
    assert rows(registry.register(frame(("a", 1)))) == [("a", 1, 3), ("x", 1, 1), ("y", 2, 2)]
    S.Numbers(spark, f"{registry.path}/numbers").take(5)  # a load that broke off behind its reservation
    assert ("n", 9, 9) in rows(registry.register(frame(("n", 9))))


def test_empty_first_load(spark, tmp_path):
    registry = S.KeyRegistry(spark, str(tmp_path / "k"), ["a"], "key")
    assert rows(registry.register(spark.createDataFrame([], "a string"))) == []
    assert rows(registry.register(spark.createDataFrame([("x",)], "a string"))) == [("x", 1)]


def test_dimension_keys_and_unknown_members(spark, tmp_path):
    star = S.StarSchema(spark, str(tmp_path))
    star.load_dimension("dim_p", spark.createDataFrame([("x", "old"), ("y", "v")], "sku string, name string"), ["sku"], "p_key")
    out = star.load_dimension("dim_p", spark.createDataFrame([("w", "n"), ("x", "new")], "sku string, name string"), ["sku"], "p_key")
    assert rows(out) == [(1, "x", "new"), (3, "w", "n")]
    facts = spark.createDataFrame([("x",), ("y",), (None,)], "s string")
    assert rows(star.with_keys(facts, {"k": ("dim_p", F.col("s"))})) == [("x", 1), ("y", -1), (None, -1)]
    star.load_calendar(spark.createDataFrame([(dt.date(2024, 2, 28),), (dt.date(2024, 3, 1),)], "d date"), "d")
    days = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2025, 1, 1),)], "d date")
    assert rows(star.with_keys(days, {"k": ("dim_time", F.col("d"))}).select("k")) == [(-1,), (20240229,)]
    with pytest.raises(ValueError):
        star.load_dimension("dim_p", spark.createDataFrame([("x", 1), ("x", 2)], "sku string, n int"), ["sku"], "p_key")


def test_fact_periods_are_replaced_and_rows_keep_their_key(spark, tmp_path):
    star = S.StarSchema(spark, str(tmp_path))
    frame = lambda *r: spark.createDataFrame(list(r), "g string, m int, v int")
    load = lambda df: rows(star.load_fact("f", df, "m", ["g", "m"], "key").select("key", "g", "m", "v"))
    assert load(frame(("a", 1, 1), ("b", 1, 1), (None, 1, 1), ("a", 2, 1))) == [(1, None, 1, 1), (2, "a", 1, 1), (3, "a", 2, 1), (4, "b", 1, 1)]
    assert load(frame(("b", 1, 9), ("c", 1, 9))) == [(3, "a", 2, 1), (4, "b", 1, 9), (5, "c", 1, 9)]
    with pytest.raises(ValueError):
        load(frame(("b", 1, 9), ("b", 1, 8)))


def test_month_end_of_a_snapshot_holds_until_the_next(spark):
    d = dt.date
    moves = spark.createDataFrame([("a", d(2024, 1, 10), 5), ("a", d(2024, 1, 10), 2), ("a", d(2024, 1, 31), -1), ("a", d(2024, 4, 5), 10),
                                   ("b", d(2024, 2, 29), 3), ("c", d(2024, 4, 20), 1)], "k string, day date, q long")
    snaps = S.stock_snapshots(moves, ["k"], "day", ["q"])
    assert rows(snaps) == [("a", d(2024, 1, 10), 7), ("a", d(2024, 1, 31), 6), ("a", d(2024, 4, 5), 16), ("b", d(2024, 2, 29), 3), ("c", d(2024, 4, 20), 1)]
    closed = S.period_close(snaps, ["k"], "day", ["q"], F.lit(d(2024, 4, 30)))
    want = [("a", d(2024, 1, 31), 6), ("a", d(2024, 2, 29), 6), ("a", d(2024, 3, 31), 6), ("a", d(2024, 4, 30), 16), ("b", d(2024, 2, 29), 3),
            ("b", d(2024, 3, 31), 3), ("b", d(2024, 4, 30), 3), ("c", d(2024, 4, 30), 1)]
    assert rows(closed) == want
    early = S.period_close(snaps, ["k"], "day", ["q"], F.lit(d(2024, 4, 29)))
    assert rows(early) == [w for w in want if w[1] < d(2024, 4, 30)]


def test_trailing_windows_count_missing_days_as_zero(spark):
    import statistics
    data = {0: 4.0, 3: 6.0, 50: 1.0, 100: 7.0}
    daily = spark.createDataFrame([("s", dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in data.items()], "k string, day date, q double")
    got = {(r["day"] - dt.date(2024, 1, 1)).days: r for r in S.replenishment_by_day(daily, ["k"], "q", 1.5, 4.0, 90).collect()}
    for i in data:
        window = [data.get(j, 0.0) for j in range(i - 89, i + 1)]
        assert got[i]["daily_demand"] == pytest.approx(statistics.mean(window)) and got[i]["demand_std"] == pytest.approx(statistics.stdev(window))
        assert got[i]["reorder_point"] == pytest.approx(4 * statistics.mean(window) + 1.5 * 2 * statistics.stdev(window))
    weekly = {str(r["week"]): r for r in S.forecast_by_week(daily, ["k"], "q", 1.0, 4).collect()}
    assert weekly["2024-01-01"]["predicted"] == 0 and weekly["2024-04-15"]["actual"] is None
    assert weekly["2024-04-15"]["predicted"] == pytest.approx(7 / 4)


def test_totals_of_a_group_equal_its_closed_keys_added_up(spark):
    from tidelake.plans.star import period_close, period_totals, stock_snapshots
    moves = spark.range(400).selectExpr("id % 23 AS sku", "id % 5 AS loc", "date_add(DATE '2020-01-05', CAST(id * id % 700 AS INT)) AS d", "id % 7 - 2 AS q")
    until = F.lit("2021-11-20").cast("date")
    got = period_totals(moves, ["sku", "loc"], ["loc"], "d", ["q"], until)
    closed = period_close(stock_snapshots(moves, ["sku", "loc"], "d", ["q"]), ["sku", "loc"], "d", ["q"], until)
    want = closed.groupBy("loc", "month_end").agg(F.count(F.lit(1)).alias("items"), F.sum("q").alias("q"))
    assert sorted(got.select("loc", "month_end", "items", "q").collect()) == sorted(want.collect()) and got.count() > 50


def test_numbers_follow_the_order_over_many_ranges_and_rows_move_once(spark, tmp_path):
    from tidelake.plans.star import Numbers, numbered
    rows = spark.range(5000).selectExpr("CASE WHEN id > 0 THEN id * 7919 % 5000 END AS a", "id AS b")
    numbers = Numbers(spark, f"{tmp_path}/numbers")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        first, second = (numbered(rows, ["a", "b"], "n", numbers) for _ in range(2))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for out, start in ((first, 0), (second, 5000)):
        got = sorted((r["n"], r["a"] if r["a"] is not None else -1) for r in out.collect())
        assert [n for n, _ in got] == list(range(start + 1, start + 5001)) and [a for _, a in got] == sorted(a for _, a in got)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def placed_rows(spark, ranged=True):
    """Two thousand rows of a few keys, dealt in ranges of the key, with NULLs."""
    rows = spark.range(2000).selectExpr("CASE WHEN id % 37 > 0 THEN id % 37 END AS g", "id % 2000 AS d", "id % 5 AS m", "id % 11 AS v")
    return rows.repartitionByRange(6, F.col("g").asc_nulls_first()) if ranged else rows.repartition(6, "d")


def in_order(rows):
    return sorted(rows, key=lambda r: (r["g"] is not None, r["g"] or 0, r["d"]))


@pytest.mark.parametrize("ranged", [True, False])
def test_placed_rows_are_numbered_where_they_lie(spark, tmp_path, ranged):
    """Also a part of them; and rows that are wrongly said to lie in ranges move after all."""
    numbers = S.Numbers(spark, f"{tmp_path}/n")
    rows, start = S.placed(placed_rows(spark, ranged), ["g", "d"], unique=True, ranged=True), 1
    for part, kept in ((rows, lambda r: True), (rows.filter("m < 3"), lambda r: r["m"] < 3), (rows.filter("m >= 3").filter("v = 1"), lambda r: r["m"] >= 3 and r["v"] == 1),
                       (rows.filter("false"), lambda r: False)):
        out = part.numbered("n", numbers)
        got, want = sorted(out.collect(), key=lambda r: r["n"]), in_order(r for r in rows.rows.collect() if kept(r))
        assert [r["n"] for r in got] == list(range(start, start + len(want))) and [tuple(r)[:4] for r in got] == [tuple(r) for r in want]
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        start += len(want)


def test_placed_rows_that_repeat_are_refused(spark):
    twice = placed_rows(spark).selectExpr("g", "d % 1999 AS d")
    for ranged in (True, False):
        with pytest.raises(ValueError):
            S.placed(twice.withColumn("g", F.lit(None).cast("long")), ["g", "d"], unique=True, ranged=ranged)
    assert S.placed(twice, ["d"]).rows.count() == 2000


def test_loads_of_placed_rows_equal_loads_of_frames(spark, tmp_path):
    """Three loads of periods, the last brings known rows and a new period; what follows from a row is worked out behind the move."""
    derive = lambda df: df.select("key", "g", "d", (F.col("v") * 2).alias("twice"), "m")
    made = []
    for label, source in (("placed", S.placed(placed_rows(spark), ["g", "d"], unique=True, ranged=True)), ("plain", placed_rows(spark, False))):
        star = S.StarSchema(spark, f"{tmp_path}/{label}")
        for held in ("m < 2", "m = 2", "m BETWEEN 1 AND 3"):
            out = star.load_fact("f", source.filter(held), "m", ["g", "d"], "key", derive)
        made.append(rows(out))
    assert made[0] == made[1] and len(made[0]) == 1600 and {r[0] for r in made[0]} == set(range(1, 1601))


def test_stock_moves_once_before_lines_become_movements(spark):
    """One range shuffle carries lines, not movements; days, windows and places need no other."""
    lines = spark.range(600).selectExpr("id % 23 AS sku", "id % 5 AS loc", "id % 3 + 0.5 AS cost", "date_add(DATE '2020-01-05', CAST(id % 50 AS INT)) AS a",
                                        "date_add(DATE '2020-01-09', CAST(id * 7 % 60 AS INT)) AS b", "id % 7 AS q")
    moves = F.array(F.struct(F.col("a").alias("d"), F.col("q").alias("n")), F.struct(F.col("b").alias("d"), (-F.col("q")).alias("n")))
    got = S.stock_snapshots(lines, ["sku", "loc"], "d", ["n"], ["cost"], moves, 20)
    flat = lines.select("sku", "loc", "cost", F.inline(moves))
    assert rows(got) == rows(S.stock_snapshots(flat, ["sku", "loc"], "d", ["n"], ["cost"]))
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange rangepartitioning")
    assert rows(S.placed(got, ["sku", "loc", "d"], unique=True, ranged=True).rows) == rows(got)
