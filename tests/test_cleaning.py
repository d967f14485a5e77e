import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tidelake.functions import text, values
from tidelake.operators import cleaning, relate, series
from tidelake.operators.cleaning import Cleaner
from tidelake.operators.density import density_noise


def one(spark, value, fn, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(fn(F.col("x")).alias("y")).first()["y"]


def test_sample_frame(spark):
    df = spark.createDataFrame([(1, 10.0, "  Alice "), (2, None, "Bob"), (2, 20.0, "Bob"), (3, 30.0, "Charlie")],
                               "id long, value double, name string")
    out = Cleaner(df).deduplicate(["id"]).fill_nulls({"value": "zero"}).standardize(["name"]).clean()
    rows = {r["id"]: (r["value"], r["name"]) for r in out.collect()}
    assert rows == {1: (10.0, "ALICE"), 2: (0.0, "BOB"), 3: (30.0, "CHARLIE")}


@pytest.mark.parametrize("raw,want", [("  é-x_1!\t", "É-X_1"), ("  ", ""), (None, None)])
def test_standardize_unicode(spark, raw, want):
    assert one(spark, raw, lambda c: text.standardize(c, remove_special=True)) == want


@pytest.mark.parametrize("raw,want", [("(020) 555-0100 12", "+10555010012"), ("123", None), (None, None), ("00441234567890", "+11234567890")])
def test_phone(spark, raw, want):
    assert one(spark, raw, text.clean_phone) == want


@pytest.mark.parametrize("raw,want", [(" A.b@C.Org ", "a.b@c.org"), ("a@b", None), ("a b@c.de", None), (None, None)])
def test_email(spark, raw, want):
    assert one(spark, raw, text.clean_email) == want


def test_parse(spark):
    assert one(spark, "2024-02-30", text.parse_date) is None
    assert one(spark, "02.01.2024", lambda c: text.parse_date(c, "%d.%m.%Y")) == dt.date(2024, 1, 2)
    assert one(spark, "2024-01-02T03:04:05", lambda c: text.parse_datetime(c, "%Y-%m-%dT%H:%M:%S")) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, "$1,250.50-x", text.parse_number) is None and one(spark, "$1,250.50", text.parse_number) == 1250.5
    with pytest.raises(ValueError):
        text.java_pattern("%Q")


def test_clip_map_bin_keep_nulls(spark):
    assert one(spark, None, lambda c: values.clip(c, 1, 2), "int") is None
    assert one(spark, None, lambda c: values.map_values(c, {"a": "b"}, "z")) == "z"
    assert one(spark, "q", lambda c: values.map_values(c, {"a": "b"}, keep_unmapped=True)) == "q"
    assert one(spark, 10, lambda c: values.bin_numeric(c, [10, 20], ["a", "b", "c"]), "int") == "a"
    assert one(spark, None, lambda c: values.bin_numeric(c, [10], ["a", "b"]), "int") is None
    with pytest.raises(ValueError):
        values.bin_numeric(F.lit(1), [1], ["a"])


def test_fill_edges(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "a double, b string")
    out = cleaning.fill_nulls(df, {"a": "mean", "b": "mode", "absent": 1}).collect()
    assert [tuple(r) for r in out] == [(None, None)] * 2
    ties = spark.createDataFrame([("b",), ("a",), (None,)], "b string")
    assert {r[0] for r in cleaning.fill_nulls(ties, {"b": "mode"}).collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        cleaning.fill_nulls(df, {"a": "forward"})


def test_drop_nulls_threshold_zero(spark):
    df = spark.createDataFrame([(1, None, 3), (1, 2, 3), (None, None, None)], "a int, b int, c int")
    assert cleaning.drop_nulls(df, threshold=0.0).count() == 1
    assert cleaning.drop_nulls(df, threshold=0.4).count() == 2
    assert cleaning.drop_nulls(df, threshold=1.0).count() == 3


def test_dedupe_is_idempotent_and_null_keys_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, None)], "k int, v int")
    once = cleaning.deduplicate(df, ["k"], "last", ["v"])
    assert sorted(map(tuple, once.collect()), key=str) == [(1, 3), (None, 2)]
    assert sorted(cleaning.deduplicate(once, ["k"], "last", ["v"]).collect(), key=str) == sorted(once.collect(), key=str)
    assert sorted(map(tuple, cleaning.deduplicate(df, ["k"], "first", ["v"]).collect()), key=str) == [(1, None), (None, 1)]
    with pytest.raises(ValueError):
        cleaning.deduplicate(df, ["k"], "any")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_against_brute_force(spark):
    names = ["".join(p) for n in range(1, 5) for p in itertools.product("AB", repeat=n)] + ["ACME LTD", "ACME LTDX", "ACNE LTD", "AB"]
    rows = [((i * 37) % 101, n) for i, n in enumerate(names)]
    got = {r["id"] for r in cleaning.deduplicate_fuzzy(spark.createDataFrame(rows, "id long, name string"), "id", "name").collect()}
    assert got == {i for i, n in rows if not any(j < i and distance(n, m) <= 1 for j, m in rows)}


def test_outlier_removal_of_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert cleaning.remove_outliers(df, "x", "zscore", 3).count() == 2
    assert cleaning.remove_outliers(df, "x").count() == 2
    with pytest.raises(ValueError):
        cleaning.remove_outliers(df, "x", "magic")


@pytest.mark.parametrize("dims,eps", [(["x"], 1.5), (["x", "y"], 4.0), (["x", "y", "z"], 9.0)])
def test_density_against_brute_force(spark, dims, eps):
    import random
    rng = random.Random(3)
    pts = [(i, float(rng.randint(0, 9)), float(rng.randint(0, 9)), rng.random() * 40) for i in range(60)]
    pts += [(100 + i, 5.0, 5.0, 20.0) for i in range(30)] + [(200, 90.0, 90.0, 90.0), (201, 90.0 + eps, 90.0, 90.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double, z double")
    at = [["id", "x", "y", "z"].index(d) for d in dims]
    near = {p[0]: [q[0] for q in pts if sum((p[a] - q[a]) ** 2 for a in at) <= eps * eps] for p in pts}
    core = {i for i, n in near.items() if len(n) >= 4}
    want = {i for i, n in near.items() if i not in core and not core & set(n)}
    assert {r["id"] for r in density_noise(df, "id", dims, eps, 4).collect()} == want


def test_except_values_counts_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",), ("z",)], "s string")
    assert sorted((r[0] for r in relate.except_values(df, "s", ["a"]).collect()), key=str) == [None, "z"]
    assert [r[0] for r in relate.except_values(df, "s", ["a", None]).collect()] == ["z"]


def test_zero_fill_single_row(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.0), ("b", dt.date(2024, 1, 3), 1.0)], "k string, day date, v double")
    rows = {(r["k"], r["day"].day): r["v"] for r in series.zero_filled(df, ["k"], "v").collect()}
    assert rows == {("a", 1): 2.0, ("a", 2): 0.0, ("a", 3): 0.0, ("b", 1): 0.0, ("b", 2): 0.0, ("b", 3): 1.0}
