import datetime as dt

import pytest
from pyspark.sql import functions as F

from queries import all_queries
from tests.oracle import compare, connect
from tidelake.functions.distributions import normal_quantile, student_quantile
from tidelake.quality import anomalies, rules as R
from tidelake.quality import schema as S
from tidelake.quality.anomalies import AnomalyScan, OutlierCheck, flag_rows, grubbs
from tidelake.quality.rules import QualityGateError, RuleSet, Severity


@pytest.fixture(scope="module")
def stock(spark):
    return spark.createDataFrame([("A1", "L1", 5.0), ("A1", "L1", -1.0), (None, "L2", None), ("b2", None, 50.0)],
                                 "sku string, loc string, qty double")


def outcome(df, *rules, refs=None):
    s = RuleSet("t", rules)
    for name, (frame, column) in (refs or {}).items():
        s.reference(name, frame, column)
    return {r["rule_name"]: r for r in s.results(df).collect()}


def test_null_treatment_differs_per_rule(spark, stock):
    ref = spark.createDataFrame([("L1",)], "id string")
    got = outcome(stock, R.not_null("sku"), R.in_range("qty", 0, 10), R.matches("sku", "^[A-Z]"), R.allowed("loc", ["L1"]),
                  R.references("loc", "places"), R.unique("sku", "loc"), R.in_range("qty", name="free"), refs={"places": (ref, "id")})
    assert {n: r["invalid_records"] for n, r in got.items()} == {
        "sku_not_null": 1, "qty_range": 2, "sku_pattern": 2, "loc_allowed": 1, "loc_in_places": 1, "sku_loc_unique": 1, "free": 0}
    assert got["free"]["passed"] and not got["qty_range"]["passed"] and got["qty_range"]["invalid_pct"] == 50.0


def test_broken_rule_fails_alone(stock):
    got = outcome(stock, R.not_null("absent"), R.not_null("sku"), R.custom("no_check", None), R.references("sku", "nowhere"),
                  R.unique("absent2"))
    assert got["sku_not_null"]["invalid_records"] == 1
    for name in ("absent_not_null", "no_check", "sku_in_nowhere", "absent2_unique"):
        assert not got[name]["passed"] and got[name]["invalid_pct"] == 100.0 and got[name]["invalid_records"] == 4
    assert "unknown reference" in got["sku_in_nowhere"]["message"]


def test_scores_of_empty_inputs(spark, stock):
    empty = RuleSet("t", [R.not_null("sku"), R.unique("sku")]).results(stock.filter("false"))
    assert R.report(empty).first()["quality_score"] == 0.0
    assert R.report(RuleSet("t").results(stock)).first()["quality_score"] == 1.0


def test_gate(stock):
    critical = RuleSet("t", [R.not_null("sku")]).results(stock)
    with pytest.raises(QualityGateError):
        R.gate(critical)
    assert R.gate(critical, fail_on_critical=False) == "quarantine"
    assert R.gate(RuleSet("t", [R.in_range("qty", 0)]).results(stock)) == "quarantine"
    assert R.gate(RuleSet("t", [R.matches("sku", "^A", Severity.WARNING)]).results(stock)) == "warn"
    assert R.gate(RuleSet("t", [R.in_range("qty", -5)]).results(stock)) == "pass"


def test_split_keeps_every_row(stock):
    good, bad = RuleSet("t", [R.in_range("qty", 0, 10), R.matches("sku", "^[A-Z]")]).split(stock)
    assert good.count() + bad.count() == stock.count() and good.columns == stock.columns
    assert {tuple(r["failed_rules"]) for r in bad.collect()} == {("qty_range",), ("sku_pattern",), ("qty_range", "sku_pattern")}


def test_freshness_and_completeness(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00' AS ts, CAST(NULL AS INT) AS x")
    assert outcome(df, R.fresh("ts", dt.datetime(2024, 1, 1, 13)))["ts_fresh"]["passed"]
    assert not outcome(df, R.fresh("ts", dt.datetime(2024, 1, 1, 15)))["ts_fresh"]["passed"]
    assert not outcome(df.filter("false"), R.fresh("ts", dt.datetime(2024, 1, 1)))["ts_fresh"]["passed"]
    assert outcome(df, R.complete(0.5))["completeness"]["passed"] and not outcome(df, R.complete())["completeness"]["passed"]


def test_literal_reference(spark, stock):
    got = RuleSet("t", [R.references("loc", "l")]).reference_values("l", stock, ["L1", "L2"]).results(stock).first()
    assert got["passed"]


def test_enforce_strict_and_lenient(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")], "sku_code string, unit_cost string")
    spec = S.TableSpec("t", (S.ColumnSpec("sku_code", "string", False), S.ColumnSpec("unit_cost", "double"), S.ColumnSpec("n", "int", True, 7)))
    out = S.enforce(df, spec)
    assert [tuple(r) for r in out.collect()] == [("1", None, 7), ("2", 3.0, 7)] and S.validate(out, spec) and not S.validate(df, spec)
    with pytest.raises(Exception):
        S.enforce(df, spec, strict=True).collect()
    with pytest.raises(S.SchemaError):
        S.enforce(df.drop("sku_code"), spec, strict=True)
    assert {tuple(r) for r in S.violations(df, spec).collect()} == {("unit_cost", "type", 1)}


def test_registry_round_trip(spark, tmp_path):
    registry = S.SchemaRegistry()
    registry.register(S.INVENTORY)
    registry.register(S.PRODUCT)
    registry.save(spark, str(tmp_path / "registry"))
    loaded = S.SchemaRegistry.load(spark, str(tmp_path / "registry"))
    assert loaded.names() == ["inventory", "product"] and loaded.get("product") == S.PRODUCT
    with pytest.raises(S.SchemaError):
        loaded.get("other")


def test_drift_halts_or_adapts(spark):
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    new = spark.createDataFrame([("2", 1.5)], "id string, price double")
    assert {(r["column_name"], r["change"]) for r in S.drift(old.schema, new).collect()} == {
        ("id", "retyped"), ("name", "dropped"), ("price", "added")}
    with pytest.raises(S.SchemaError):
        S.adapt(old.schema, new, halt=True)
    assert tuple(S.adapt(old.schema, new).first()) == (2, None, 1.5)


def test_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(5.0,)] * 40, "x double")
    assert AnomalyScan().zscore("x").mad("x").iqr("x").percentile("x").findings(df).count() == 0


def test_tiny_and_empty_frames(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    scan = AnomalyScan().require("x").non_negative("x").zscore("x").mad("x").iqr("x").percentile("x").spike("x").volume(0, 5)
    assert scan.findings(df, df).count() == 0
    assert scan.findings(df.filter("false"), df).count() == 0
    assert AnomalyScan().findings(df).count() == 0
    assert anomalies.health_score(AnomalyScan().findings(df)).first()["health_score"] == 100


def test_history_absent_or_zero(spark):
    df = spark.createDataFrame([(9.0,)], "x double")
    zero = spark.createDataFrame([(0.0,)], "x double")
    assert AnomalyScan().spike("x").drop("x").findings(df).count() == 0
    assert AnomalyScan().spike("x").drop("x").findings(df, zero).count() == 0
    assert AnomalyScan().spike("x", 10).findings(df, spark.createDataFrame([(1.0,)], "x double")).first()["deviation_score"] == 800.0


def test_null_share_severity_and_floor(spark):
    df = spark.range(200).select(F.when(F.col("id") > 0, F.col("id")).alias("a"), F.when(F.col("id") > 10, 1).alias("b"),
                                 F.when(F.col("id") > 100, 1).alias("c"))
    got = {r["column_name"]: r["severity"] for r in AnomalyScan().require("a", "b", "c", "d").findings(df).collect()}
    assert got == {"a": "medium", "b": "high", "c": "critical", "d": "critical"}
    assert anomalies.health_score(AnomalyScan().require("a", "b", "c", "d").findings(df)).first()["health_score"] == 0


def test_two_checks_on_one_column(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)] + [(500.0,)], "x double")
    found = AnomalyScan().iqr("x", 1.5).iqr("x", 100.0).zscore("x").findings(df).collect()
    assert sorted(r["anomaly_id"] for r in found) == ["outlier_iqr_x", "outlier_zscore_x"]
    assert [r["x"] for r in flag_rows(df, OutlierCheck("x", "iqr", 1.5)).collect()] == [500.0]
    assert flag_rows(df, OutlierCheck("x", "iqr", 1.5), min_samples=100).count() == 0


@pytest.mark.parametrize("n,want", [(10, 2.290), (20, 2.709), (50, 3.128), (100, 3.384)])
def test_grubbs_critical_values(spark, n, want):
    df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("x"))
    assert grubbs(df, ["k"], "x", critical=True).first()["critical"] == pytest.approx(want, abs=2e-3)


def test_no_python_worker_needed_without_verdict(spark):
    df = spark.range(5).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("x"))
    assert "Python" not in grubbs(df, ["k"], "x")._jdf.queryExecution().executedPlan().toString()


def test_rules_of_one_name_are_told_apart(spark):
    df = spark.range(100).withColumnRenamed("id", "q")
    rules = R.RuleSet("t", [R.in_range("q", 0, 10), R.in_range("q", 0, 50)])
    assert {r["rule_name"]: r["invalid_records"] for r in rules.results(df).collect()} == {"q_range": 89, "q_range_2": 49}
    assert rules.split(df)[1].count() == 89


@pytest.mark.parametrize("n,want", [(3, 1.1543), (4, 1.4812), (5, 1.7150), (6, 1.8871), (50, 3.128), (100, 3.384)])
def test_grubbs_values_are_exact_for_few_rows(spark, n, want):
    t = spark.range(1).select(student_quantile(F.lit(n - 2), F.lit(0.05 / n))).first()[0]
    assert (n - 1) / n**0.5 * (t * t / (n - 2 + t * t)) ** 0.5 == pytest.approx(want, abs=6e-4)


def test_grouped_outliers_need_enough_samples(spark):
    rows = [("big", float(i % 5)) for i in range(39)] + [("big", 90.0)] + [("small", float(i % 5)) for i in range(28)] + [("small", 90.0)]
    scan = AnomalyScan(min_samples=30).zscore("x", 2.0)
    assert [tuple(r) for r in scan.grouped_outliers(spark.createDataFrame(rows, "k string, x double"), ["k"]).collect()] == [("big", 90.0)]
    with pytest.raises(ValueError):
        AnomalyScan().iqr("x").grouped_outliers(spark.createDataFrame(rows, "k string, x double"), ["k"])


def test_min_samples_flags_every_day(spark):
    """At the largest scale, where hours of 30 events exist beside smaller ones."""
    name, folder = "anom_min_samples_hourly", "/root/testdata/sf0.1"
    out = all_queries()[0][name](spark, folder)
    assert compare(name, out, connect(folder), all_queries()[1][name]) == ""
    assert len({r["hour"].date() for r in out.collect()}) == 30


def test_findings_with_samples(spark):
    df = spark.createDataFrame([(i, float(i % 9)) for i in range(200)] + [(900, 500.0), (901, -70.0), (902, None), (903, 500.0)], "id int, x double")
    scan = AnomalyScan().require("x", "gone").non_negative("x").iqr("x").iqr("x", 20.0, "high").rule("small", F.col("id") < 901).volume(1, 2)
    got = {r["anomaly_id"]: r for r in scan.detailed(df, detected_at=dt.datetime(2024, 5, 1), samples=2).collect()}
    plain = {r["anomaly_id"]: r.asDict() for r in scan.findings(df).collect()}
    assert {k: {c: r[c] for c in plain[k]} for k, r in got.items()} == plain and {r["detected_at"] for r in got.values()} == {dt.datetime(2024, 5, 1)}
    assert list(got["outlier_iqr_x"]["sample_values"]) == ["500.0", "500.0"] and '"id":900' in "".join(got["outlier_iqr_x"]["sample_records"])
    assert got["outlier_iqr_x"]["affected_records"] == 3 and got["outlier_iqr_x"]["details"] == {"q1": 2.0, "q3": 6.0, "iqr": 4.0}
    assert got["outlier_iqr_x_2"]["severity"] == "high" and got["outlier_iqr_x_2"]["affected_records"] == 2
    assert list(got["validation_x_negative"]["sample_values"]) == ["-70.0"] and "1 rows" in got["validation_x_negative"]["description"]
    assert len(got["validation_small"]["sample_records"]) == 2 and list(got["validation_x_nulls"]["sample_records"]) == ['{"id":902}']
    assert list(got["volatility_volume_high"]["sample_records"]) == [] and "absent" in got["validation_gone_missing"]["description"]
    assert AnomalyScan().iqr("x").detailed(df.limit(0)).collect() == [] and AnomalyScan().detailed(df).collect() == []


def test_samples_need_no_scan_per_check(spark, folder):
    from queries.registry import Tables
    events = Tables(spark, folder).events
    scan = AnomalyScan().non_negative("value").iqr("value").zscore("value").percentile("value").mad("value")
    text = scan.detailed(events, detected_at=dt.datetime(2024, 5, 1))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2 and text.count("WindowGroupLimit") == 2
    rules = R.RuleSet("x", [R.in_range("value", 0, 5, name=str(i)) for i in range(10)])
    assert rules.samples(events)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_rule_samples_keep_the_order_of_their_type(spark):
    df = spark.createDataFrame([(i, str(i)) for i in (9, 10, 100, 2, 10)] + [(None, None)], "n int, s string")
    got = R.RuleSet("t", [R.in_range("n", 0, 1), R.in_range("s", "0", "0"), R.not_null("n")]).results_with_samples(df, 2)
    assert {r["rule_name"]: list(r["sample_invalid"]) for r in got.collect()} == {"n_range": ["2", "9"], "s_range": ["10", "100"], "n_not_null": []}


def test_tier_gate(spark):
    df = spark.createDataFrame([(float(i % 9),) for i in range(50)] + [(99.0,)], "x double")
    flagged = AnomalyScan().iqr("x").findings(df)
    assert R.gate_tiers(flagged) == "flag" and R.gate_tiers(flagged, {2: "alert"}) == "alert" and R.gate_tiers(flagged.limit(0)) == "pass"
    with pytest.raises(QualityGateError):
        R.gate_tiers(AnomalyScan().require("gone").iqr("x").findings(df))
    with pytest.raises(ValueError):
        R.tier_actions(flagged, {1: "explode"})


def test_velocity_crosses_the_border(spark):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    schema = "k string, ts timestamp_ntz, v double"
    history = spark.createDataFrame([("a", at(0), 1.0), ("a", at(2), 3.0), ("a", at(3), 2.0), ("one", at(0), 0.0), (None, at(0), 0.0)], schema)
    current = spark.createDataFrame([("a", at(4), 2.5), ("a", at(5), 9.0), ("a", at(5), 9.5), ("a", at(6), 9.4), ("one", at(1), 100.0), ("new", at(1), 1.0),
                                     (None, at(1), 9.0)], schema)
    got = anomalies.velocity_check(current, history, "k", "ts", "v", ["v"])
    assert [(r["k"], r["v"], r["rate"], r["min_rate"], r["max_rate"]) for r in got.collect()] == [("a", 9.0, 6.5, -1.0, 1.0)]


def test_season_ignores_masked_days(spark):
    start = dt.date(2023, 1, 2)
    days = [(start + dt.timedelta(days=i), 100.0 + 10 * (i % 7) + 3 * ((i // 7) % 4) + (i * 37 % 5) * 0.1) for i in range(364)]
    odd, event = days[100][0], days[200][0]
    rows = [("s", d, v + (80 if d in (odd, event) else 0)) for d, v in days]
    df = spark.createDataFrame(rows, "k string, day date, v double")
    out = anomalies.context_season(df, ["k"], "v", [event], 6.0).collect()
    assert {(r["day"], r["is_event"]) for r in out} == {(odd, False), (event, True)} and all(abs(r["expected"] + 80 - r["v"]) < 3 for r in out)
    assert anomalies.context_season(df.limit(0), ["k"], "v").count() == 0


@pytest.mark.parametrize("g,kept", [(1.48105, 1), (1.48115, 0), (1.48125, 0), (1.48135, 1)])
def test_small_groups_are_held_against_the_published_value(spark, g, kept):
    """The critical value of four is 1.48125, published as 1.4812: half-way values do not round alike everywhere."""
    from types import SimpleNamespace

    from queries.anomaly import grubbs_small_groups
    e = ((1.6875 / g**2 - 0.75) / 2) ** 0.5
    events = spark.createDataFrame([(i + 1, None, 1, "a", v) for i, v in enumerate([0.0, e, -e, 1.0])],
                                   "event_id long, ts timestamp, user_id long, event_type string, value double")
    assert grubbs_small_groups(SimpleNamespace(events=events)).count() == kept
