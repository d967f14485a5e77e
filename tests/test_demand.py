import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidelake.plans import demand as M


def series(spark, data):
    rows = [(k, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(x)) for k, xs in data.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "k string, day date, demand double")


RNG = random.Random(5)
DATA = {"smooth": [RNG.randint(8, 12) for _ in range(60)], "zero": [0] * 60, "sparse": [5 if i % 7 == 0 else 0 for i in range(60)],
        "lumpy": [RNG.choice([0, 0, 0, 1, 90]) for _ in range(60)], "one": [3]}


def croston(xs, a=0.1):
    z = p = None
    q = 1
    for x in xs:
        if x > 0:
            z, p = (x, q) if z is None else (a * x + (1 - a) * z, a * q + (1 - a) * p)
            q = 1
        else:
            q += 1
    return z / p if z is not None else 0.0


def tsb(xs, a=0.1, b=0.1):
    p = z = None
    for x in xs:
        hit = 1.0 if x > 0 else 0.0
        p = hit if p is None else p + b * (hit - p)
        if x > 0:
            z = x if z is None else z + a * (x - z)
    return p * z if z is not None else 0.0


def ses(xs, a=0.3):
    level = xs[0]
    for x in xs[1:]:
        level = a * x + (1 - a) * level
    return level


def test_folds_against_loops(spark):
    out = {r["k"]: r for r in M.forecast(M.as_series(series(spark, DATA), ["k"], "demand"), ["k"]).collect()}
    for k, xs in DATA.items():
        assert out[k]["ses"] == pytest.approx(ses(xs)) and out[k]["croston"] == pytest.approx(croston(xs))
        assert out[k]["sba"] == pytest.approx(croston(xs) * 0.95) and out[k]["tsb"] == pytest.approx(tsb(xs))
        assert out[k]["moving_average"] == pytest.approx(sum(xs[-28:]) / len(xs[-28:]))
    assert out["one"]["holt_winters"] is None and out["zero"]["holt_winters"] == 0.0


def test_holt_winters_keeps_a_pure_season(spark):
    xs = [10 + 3 * (i % 7) for i in range(70)]
    df = M.as_series(series(spark, {"s": xs}), ["k"], "demand")
    assert df.select(M.holt_winters(F.col("series")).alias("f")).first()["f"] == pytest.approx(10.0)


def test_patterns(spark):
    out = {r["k"]: r["pattern"] for r in M.demand_pattern(series(spark, DATA), ["k"], "demand").collect()}
    assert out == {"smooth": "smooth", "zero": "lumpy", "sparse": "intermittent", "lumpy": "lumpy", "one": "smooth"}


def test_backtest_and_selection(spark):
    df = series(spark, {k: v for k, v in DATA.items() if k != "one"})
    scores = M.backtest_scores(M.as_series(df, ["k"], "demand"), ["k"], 10, 2, ["croston", "sba", "ses"])
    got = {(r["k"], r["method"]): r["mae"] for r in scores.collect()}
    for k, xs in DATA.items():
        if k == "one":
            continue
        want = sum(abs(croston(xs[:60 - f * 10]) - sum(xs[60 - f * 10:70 - f * 10]) / 10) for f in (1, 2)) / 2
        assert got[k, "croston"] == pytest.approx(want)
    best = {r["k"]: r for r in M.model_selection(scores, M.demand_pattern(df, ["k"], "demand"), ["k"]).collect()}
    assert best["smooth"]["method"] == "ses" and best["lumpy"]["method"] == "sba"
    options = {m: got["sparse", m] for m in ("croston", "sba")}
    assert best["sparse"]["mae"] == pytest.approx(min(options.values()))


def test_interval_widens(spark):
    rows = M.forecast_interval(M.as_series(series(spark, {"s": DATA["smooth"]}), ["k"], "demand"), ["k"], 5).orderBy("step").collect()
    width = [r["upper"] - r["forecast"] for r in rows]
    assert width[3] == pytest.approx(2 * width[0]) and len({r["forecast"] for r in rows}) == 1


def test_replenishment_formulas(spark):
    xs = DATA["smooth"]
    r = M.replenishment(series(spark, {"s": xs}), ["k"], "demand", 9, 0.95, 50.0, 2.0).first()
    mean = sum(xs) / len(xs)
    std = math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1))
    assert r["safety_stock"] == pytest.approx(1.6449 * std * 3) and r["reorder_point"] == pytest.approx(mean * 9 + 1.6449 * std * 3)
    assert r["eoq"] == pytest.approx(math.sqrt(2 * mean * 365 * 50 / 2))


def test_abc_shares(spark):
    df = spark.createDataFrame([("a", 80.0, 0.1), ("b", 15.0, 0.7), ("c", 5.0, None)], "k string, rev double, cv double")
    out = {r["k"]: (r["abc_class"], r["xyz_class"]) for r in M.abc_xyz(df, "k", "rev", "cv").collect()}
    assert out == {"a": ("A", "X"), "b": ("B", "Y"), "c": ("C", "Z")}
