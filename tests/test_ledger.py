"""Deferred drops: the one-pass report equals a measurement of every step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from queries import all_queries
from tidelake.operators import cleaning, ledger
from tidelake.operators.cleaning import Cleaner
from tidelake.plans.flows import SilverTransform
from tidelake.quality import rules as R


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def frame(spark):
    data = [(i % 7 if i % 11 else None, None if i % 5 == 0 else float(i % 13), ["a ", "B", None, ""][i % 4], str(i) if i % 9 else "x",
             dt.date(2024, 1, 1 + i % 28)) for i in range(300)] + [(1, 5000.0, "b", "3", None), (1, float("nan"), "b", "3", None)]
    return spark.createDataFrame(data, "k int, v double, s string, n string, d date")


CHAINS = {
    "filter, dedupe, fill": lambda c: c.filter("k > 1").deduplicate(["k", "s"], "last", ["d"]).fill_nulls({"v": 0.0, "s": "?"}).filter("v < 10"),
    "dedupe twice": lambda c: c.deduplicate(["k", "v"]).deduplicate(["k"], "last", ["v"]),
    "means without what went": lambda c: c.filter("v < 100").fill_nulls({"v": "mean", "s": "mode"}).remove_outliers("v", "zscore", 1.0),
    "a constant, then a fence": lambda c: c.filter(F.col("k") >= 3).fill_nulls({"v": 9999.0}).remove_outliers("v", "iqr", 0.1),
    "nulls": lambda c: c.drop_nulls(["k", "v"]).drop_nulls(threshold=0.2).standardize(["s"]).rename({"k": "key"}).deduplicate(["key", "s"]),
    "ordered fill": lambda c: c.deduplicate(["k", "d"], "first", ["v", "s", "n"]).fill_nulls({"v": "forward"}, keys=["k"], order="d", tiebreak=["n"]),
    "bad numbers go first": lambda c: c.filter("n <> 'x'").add_column("m", F.col("n").cast("int")).filter("m > 5").drop_columns(["n"]),
    "nothing": lambda c: c,
}


@pytest.mark.parametrize("name", CHAINS)
def test_report_equals_measurement(frame, name):
    one = CHAINS[name](Cleaner(frame))
    assert rows(one.report()) == rows(one._measured()) if one.steps else one.report().collect() == []


@pytest.mark.parametrize("name", CHAINS)
def test_empty_table(frame, name):
    one = CHAINS[name](Cleaner(frame.limit(0)))
    changed = {"nulls_filled", *cleaning._ROW_STEPS}
    assert all(r["affected"] == 0 for r in one.report().collect() if r["action"] in changed)


def test_living_rows_equal_the_plain_step(frame):
    plain = cleaning.deduplicate(frame, ["k", "s"], "last", ["v"])
    kept = cleaning.deduplicate_in_ledger(ledger.opened(frame), ["k", "s"], "last", ["v"], 3)
    assert rows(kept.filter(ledger.alive()).select(*frame.columns)) == rows(plain)
    assert kept.agg(F.sum(ledger.WEIGHT)).first()[0] == frame.count()
    assert rows(frame.filter(cleaning.without_nulls(frame, ["v", "s"]))) == rows(cleaning.drop_nulls(frame, ["v", "s"]))


def test_unknown_steps_are_measured(frame):
    one = Cleaner(frame).apply("rows_filtered", "", lambda d: d.filter("k = 1").limit(5)).filter("v > 3")
    assert [r["affected"] for r in one.report().orderBy("step").collect()][0] == frame.count() - 5


def test_report_is_one_scan(spark, folder):
    plan = all_queries()[0]["cleaning_report"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_run_reads_its_source_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 300 AS k", "IF(id % 10 = 0, NULL, id) AS v", "id % 7 AS w").write.parquet(str(tmp_path / "in"))
    reads = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        reads.add(1)
        return True

    source = spark.read.parquet(str(tmp_path / "in")).filter(seen("k"))
    flow = SilverTransform("t", drop_null=["v"], derive={"x": "v * 2"}, dedupe_on=["k"], rules=R.RuleSet("t", [R.in_range("w", 0, 3)]))
    row = flow.run(source, str(tmp_path)).first()
    assert row["records_in"] == 1000 and row["records_in"] == row["records_out"] + row["records_rejected"] + row["records_filtered"]
    good = spark.read.parquet(str(tmp_path / "silver" / "t"))
    assert good.columns == ["k", "v", "w", "x"] and good.count() == row["records_out"] > 0
    want, bad = flow.split(source)
    assert rows(good) == rows(want) and row["records_rejected"] == bad.count() > 0
    reads.value = 0
    flow.run(source, str(tmp_path))
    assert reads.value == 1000
