"""Bootstrap, forest and conformal intervals against plain loops and naive forecasts."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidelake.plans import demand as M


@pytest.fixture(scope="module")
def series(spark):
    draw = random.Random(4)
    rows = [(0, [0.0] * 200), (1, [5.0] * 200), (2, [float(draw.random() < 0.15) * draw.randint(1, 9) for _ in range(700)]),
            (3, [float(draw.random() < 0.5) * draw.randint(1, 4) for _ in range(700)]), (4, [3.0]), (5, [0.0, 0.0, 2.0])]
    return spark.createDataFrame(rows, "k long, series array<double>")


def plain_totals(xs, seed, lead, replicates):
    def draw(*parts):
        z = (seed * 7919 + parts[0] * 104729 + parts[1] * 1299709 + parts[2]) % 2147483647
        for f in (48271, 16807, 69621):
            z = (z * f + 1) % 2147483647
        return z

    pairs = list(zip(xs, xs[1:]))
    off, on = [b > 0 for a, b in pairs if a == 0], [b > 0 for a, b in pairs if a > 0]
    p = [sum(off) / len(off) if off else 0.0, sum(on) / len(on) if on else 0.0]
    sizes, out = [x for x in xs if x > 0], []
    for r in range(1, replicates + 1):
        state, total = xs[-1] > 0, 0.0
        for step in range(1, lead + 1):
            state = bool(sizes) and draw(r, step, 0) / 2147483647.0 < p[state]
            total += sizes[draw(r, step, 1) % len(sizes)] if state else 0
        out.append(total)
    return out


def test_bootstrap_equals_a_plain_loop(series):
    rows = series.select("k", "series", M.bootstrap_totals(F.col("series"), F.col("k") + 11, 20, 40).alias("t")).collect()
    for r in rows:
        assert list(r["t"]) == plain_totals(list(r["series"]), r["k"] + 11, 20, 40)
    assert {t for r in rows if r["k"] in (0, 4) for t in r["t"]} == {0.0} and {t for r in rows if r["k"] == 1 for t in r["t"]} == {100.0}


def test_lead_time_demand_covers(series):
    got = {r["k"]: r for r in M.lead_time_demand(series, ["k"], F.col("k"), 20, (0.5, 0.95, 1.0), 200).collect()}
    for k, xs in ((r["k"], list(r["series"])) for r in series.collect()):
        totals = sorted(plain_totals(xs, k, 20, 200))
        assert [got[k][c] for c in ("cover_50", "cover_95", "cover_100")] == [totals[99], totals[189], totals[199]]
        assert got[k]["mean_demand"] == pytest.approx(sum(totals) / 200)
    mean = sum(next(list(r["series"]) for r in series.collect() if r["k"] == 3)) / 700 * 20
    assert got[3]["mean_demand"] == pytest.approx(mean, rel=0.25)


def test_conformal_intervals_equal_a_plain_loop(series):
    two = series.filter("k IN (2, 3, 4)")
    got = {(r["k"], r["step"]): r for r in M.conformal_intervals(two, ["k"], 10, 9, 0.8, ["moving_average"]).collect()}
    assert {k for k, _ in got} == {2, 3} and len(got) == 20  # the short series has none
    for k, xs in ((r["k"], list(r["series"])) for r in two.filter("k < 4").collect()):
        flat = lambda x: sum(x[-28:]) / 28
        for step in range(1, 11):
            errors = sorted(abs(xs[len(xs) - 10 * f + step - 1] - flat(xs[: len(xs) - 10 * f])) for f in range(1, 10))
            radius = errors[math.ceil(10 * 0.8) - 1]
            r = got[k, step]
            assert (r["forecast"], r["upper"]) == (pytest.approx(flat(xs)), pytest.approx(flat(xs) + radius)) and r["lower"] == pytest.approx(max(0, flat(xs) - radius))
    cover = M.conformal_coverage(two, ["k"], 10, 9, 0.8, ["moving_average", "sba"]).collect()
    assert {r["method"] for r in cover} == {"moving_average", "sba"} and all(r["days"] == 20 and r["covered"] >= 10 for r in cover)


def test_forest_beats_the_last_days(spark, folder):
    from queries.demand import KEYS, all_series, grid
    from queries.registry import Tables
    t = Tables(spark, folder)
    forest = M.tree_backtest(grid(t), KEYS, "demand", 30, 2)
    rows = forest.collect()
    assert len(rows) == all_series(t).count() and {r["folds"] for r in rows} == {2}
    naive = M.backtest_scores(all_series(t), KEYS, 30, 2, ["moving_average"]).agg(F.avg("mae")).first()[0]
    assert sum(r["mae"] for r in rows) / len(rows) < 1.05 * naive
    assert M.tree_backtest(grid(t).limit(0), KEYS, "demand", 30, 2).collect() == []


def test_selection_has_the_new_methods_in_its_lists(spark):
    scores = spark.createDataFrame([("a", "random_forest", 1.0), ("a", "ses", 2.0), ("b", "bootstrap", 0.5), ("b", "sba", 0.6), ("b", "random_forest", 0.1)],
                                   "k string, method string, mae double").withColumn("folds", F.lit(1))
    patterns = spark.createDataFrame([("a", "erratic"), ("b", "lumpy")], "k string, pattern string")
    assert {r["k"]: r["method"] for r in M.model_selection(scores, patterns, ["k"]).collect()} == {"a": "random_forest", "b": "bootstrap"}


def test_any_service_level(spark):
    from statistics import NormalDist
    grid = spark.createDataFrame([("a", i % 3 * 1.0) for i in range(30)], "k string, q double")
    one = lambda level: M.replenishment(grid, ["k"], "q", 4.0, level).first()["safety_stock"]
    assert one(0.876) / one(0.95) == pytest.approx(NormalDist().inv_cdf(0.876) / 1.6449)
    assert one(F.lit(0.876)) == pytest.approx(one(0.876))


def test_a_grid_gets_tasks_by_its_days(spark, monkeypatch):
    """Few rows that make a long grid are not left to the few tasks that their bytes ask for."""
    from tidelake.operators import series as S
    daily = spark.createDataFrame([(k, dt.date(2020, 1, 1 + k % 3) + dt.timedelta(days=300 * j), 1.5) for k in range(20) for j in range(2)], "k int, day date, v double")
    monkeypatch.setattr(S, "GRID_ROWS", 300)
    grid = S.zero_filled(daily, ["k"], "v")
    assert grid.count() == 20 * 303
    assert S.calendar_span(daily, ["k"])[2] >= 18
    assert "REPARTITION_BY_NUM" in grid._jdf.queryExecution().executedPlan().toString()
    wide = S.zero_filled(daily, ["k"], "v", F.lit("2019-12-30").cast("date"), F.lit("2020-12-31").cast("date"))
    assert wide.count() == 20 * 368 and S.zero_filled(daily.limit(0), ["k"], "v").count() == 0
    dense = {r["k"]: list(r["series"]) for r in S.filled_series(daily, ["k"], "v").collect()}
    assert dense == {r["k"]: list(r["series"]) for r in M.as_series(grid, ["k"], "v").collect()}


def test_cut_offs_in_one_pass_equal_each_method_on_its_slice(series):
    methods = list(M.METHODS)
    got = {(r["k"], r["method"]): list(r["at"]) for r in M.fold_forecasts(series.filter("k IN (2, 3)"), ["k"], 10, 6, methods).collect()}
    for fold in (0, 3, 6):
        cut = series.filter("k IN (2, 3)").withColumn("series", F.slice("series", F.lit(1), F.size("series") - 10 * fold))
        for r in M.forecast(cut, ["k"], methods).collect():
            assert {m: got[r["k"], m][fold] for m in methods} == {m: r[m] for m in methods}


def test_boosting_on_weighted_rows_equals_boosting_on_all(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    draw = random.Random(9)
    rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(days=i % 100), float(i % 5), float(i % 3), i % 5 * 2.0 - i % 3 + draw.random()) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, day date, a double, b double, label double")
    got = {r["k"]: r["prediction"] for r in M.tree_forecast(df, ["k"], F.lit(dt.date(2020, 3, 1)), "gbt").collect()}
    wide = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = GBTRegressor(maxIter=20, maxDepth=4, seed=7).fit(wide.filter("day < DATE '2020-03-01'"))
    want = {r["k"]: r["prediction"] for r in model.transform(wide.filter("day >= DATE '2020-03-01'")).collect()}
    assert got == pytest.approx(want, rel=1e-6) and len(got) == 600


def test_methods_that_are_not_wanted_are_not_run(series):
    """A series that wants some methods gets the very scores that it gets among all."""
    listed = series.withColumn("w", F.when(F.col("k") % 2 == 0, F.array(F.lit("sba"), F.lit("bootstrap"))).otherwise(F.array(F.lit("moving_average"), F.lit("random_forest"))))
    got = {(r["k"], r["method"]): (r["mae"], r["folds"]) for r in M.backtest_scores(listed, ["k"], 30, 3, wanted=F.col("w")).collect()}
    every = {(r["k"], r["method"]): (r["mae"], r["folds"]) for r in M.backtest_scores(series, ["k"], 30, 3).collect()}
    assert got and got == {(k, m): v for (k, m), v in every.items() if m in (("sba", "bootstrap") if k % 2 == 0 else ("moving_average",))}


def test_trees_draw_rows_and_learn_from_cells(spark, monkeypatch):
    """No tree is fitted on rows: a forest's rows are drawn one by one and added up per cell, with the mean and spread of a Poisson draw."""
    drawn = spark.range(40000).select(*[M._drawn(["id"], tree, 7).alias(f"n_{tree}") for tree in range(2)])
    found = drawn.agg(F.avg("n_0").alias("mean"), F.var_samp("n_0").alias("var"), F.corr("n_0", "n_1").alias("corr"), F.max("n_0").alias("most")).first()
    assert found["mean"] == pytest.approx(1, abs=0.02) and found["var"] == pytest.approx(1, abs=0.05) and abs(found["corr"]) < 0.02 and found["most"] >= 5
    written = {}
    keep = M.materialise
    monkeypatch.setattr(M, "materialise", lambda df, label: written.setdefault(label, keep(df, label)))
    grid = spark.createDataFrame([(k, dt.date(2020, 1, 1) + dt.timedelta(days=d), float((d + k) % 7 == 0) * 3) for k in range(7) for d in range(400)], "k int, day date, q double")
    scores = M.tree_backtest(grid, ["k"], "q", 30, 2).collect()
    assert len(scores) == 7 and all(r["mae"] < 0.1 and r["folds"] == 2 for r in scores)
    cells = written["tree-cells"]
    learned = written["tree-features"].filter(F.col("day") <= F.date_sub(F.lit(written["tree-features"].agg(F.max("day")).first()[0]), 30)).count()
    rows = sum(cells.agg(*[F.sum(f"n_{t}") for t in range(10)]).first()) / 10
    assert rows == pytest.approx(learned, rel=0.05) and cells.count() < learned / 3


def test_borders_give_heavy_values_a_bin():
    assert M._borders([0.0] * 10) == [] and M._borders([0.0] * 9 + [2.0]) == [1.0]
    many = M._borders([0.0] * 780 + [float(i) for i in range(1, 222)])
    assert len(many) <= M.BINS - 1 and many[0] == 0.5 and many[-1] > 150


def plain_features(xs):
    for i in range(14, len(xs)):
        week, past = [x for x in xs[i - 7:i] if x is not None], [xs[i], xs[i - 1], xs[i - 7], xs[i - 14]]
        if None not in past and not any(math.isnan(x) for x in [*week, *past]):
            yield i, (xs[i], sum(week) / len(week), *past[1:])


def test_lag_features_equal_a_plain_loop(spark):
    """From whole series, so that a day costs one look into an array: with unknown values, and series that are too short."""
    draw = random.Random(3)
    data = {k: [draw.choice([0.0, 0.0, draw.randint(1, 36) / 4]) for _ in range(60)] for k in range(4)} | {4: [1.0] * 14, 5: [1.0] * 15, 6: [2.0]}
    data[1][20], data[2][30] = None, math.nan
    first = dt.date(2020, 2, 1)
    series = spark.createDataFrame([(k, first, xs) for k, xs in data.items()], "k int, start date, series array<double>")
    got = {(r["k"], r["day"]): r for r in M.lag_features(series, ["k"]).collect()}
    want = {(k, first + dt.timedelta(days=i)): v for k, xs in data.items() for i, v in plain_features(xs)}
    assert got.keys() == want.keys() and {k for k, _ in got} == {0, 1, 2, 3, 5}
    for (k, day), r in got.items():
        assert (r["label"], r["mean_7"], r["lag_1"], r["lag_7"], r["lag_14"]) == want[k, day]
        assert (r["weekday"], r["month"]) == (day.isoweekday() % 7 + 1, day.month)


def test_rows_without_a_day_add_nothing_to_a_series(spark):
    from tidelake.operators.series import filled_series
    daily = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2.0), (1, None, 9.0), (1, dt.date(2020, 1, 4), 3.0), (2, None, 5.0)], "k int, day date, v double")
    got = {r["k"]: (r["start"], r["series"]) for r in filled_series(daily, ["k"], "v", first="start").collect()}
    assert got == {1: (dt.date(2020, 1, 1), [2.0, 0.0, 0.0, 3.0]), 2: (dt.date(2020, 1, 1), [0.0] * 4)}


@pytest.fixture(scope="module")
def different(spark):
    """Rows of which no two agree."""
    draw = random.Random(8)
    points = [(draw.lognormvariate(0, 2), draw.gauss(0, 1)) for _ in range(12000)]
    rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(days=i % 100), a, b, math.log(a) * 3 + abs(b) * 5 + draw.random()) for i, (a, b) in enumerate(points)]
    return spark.createDataFrame(rows, "k int, day date, a double, b double, label double").cache()


@pytest.mark.parametrize(("kind", "label"), [("gbt", "weighted"), ("random_forest", "tree-cells")])
def test_trees_learn_from_cells_however_many_rows_differ(spark, different, kind, label, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    written, keep = {}, M.materialise
    monkeypatch.setattr(M, "materialise", lambda df, label: written.setdefault(label, keep(df, label)))
    error = F.avg((F.col("prediction") - F.col("label")) ** 2)
    scored = M.tree_forecast(different, ["k"], F.lit(dt.date(2020, 3, 1)), kind)
    got = scored.agg(error, F.count("prediction")).first()
    assert list(written) == [label] and written[label].count() <= M.BINS ** 2 and got[1] == different.filter("day >= DATE '2020-03-01'").count()
    wide = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(different)
    model = GBTRegressor(maxIter=20, maxDepth=4, seed=7) if kind == "gbt" else RandomForestRegressor(numTrees=20, maxDepth=5, seed=7)
    want = model.fit(wide.filter("day < DATE '2020-03-01'")).transform(wide.filter("day >= DATE '2020-03-01'")).agg(error).first()[0]
    assert got[0] < 1.1 * want


def test_value_groups_count_every_row(spark):
    """Heavy values, signs, orders of magnitude and values without an order, which are left to the outer bins."""
    values = [0.0] * 50 + [float(i) for i in range(-20, 300)] + [1e-9, 1e12, -1e12, math.inf, -math.inf, math.nan, None]
    groups = M._value_groups(spark.createDataFrame([(v, float(i % 7)) for i, v in enumerate(values)], "a double, b double"), ["a", "b"])
    assert sum(n for *_, n in groups["a"]) == len(values) - 4 and [n for lo, hi, n in groups["a"] if lo <= 0 <= hi] == [51]
    assert all(hi < lo for (_, hi, _), (lo, _, _) in zip(groups["a"], groups["a"][1:])) and all(hi == lo for lo, hi, _ in groups["a"])
    assert [lo for lo, _, _ in groups["b"]] == [float(i) for i in range(7)] and len(M._parted(groups["a"])) <= M.BINS - 1
    rows = spark.createDataFrame([(-math.inf,), (0.0,), (math.inf,)], "a double")
    low, mid, high = [r["a"] for r in M._binned(rows, rows, ["a"]).collect()]
    assert low <= mid <= high and low < high
