"""Table flows end to end, run metadata, reliability and freshness of runs."""

import datetime as dt

from pyspark.sql import functions as F

from queries.cleaning import GAPS_SQL, gaps
from queries.registry import query
from tidelake.plans import flows
from tidelake.plans.flows import BronzeExtract, SilverTransform
from tidelake.quality import rules as R
from tidelake.quality.rules import RuleSet
from tidelake.session import scratch
from tidelake.quality.schema import unreadable_files
from tidelake.sinks.tables import write_table
from tidelake.sources.files import filesystem, parquet_footers

EXTRACTED = dt.datetime(2024, 3, 1, 6, 30)


@query("bronze_extract", """
SELECT o_orderkey, o_orderstatus, 'erp' AS _source_system, '2024-03-01' AS _extract_date,
  md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus) AS _row_hash, DATE '2024-03-01' AS extract_date FROM orders""")
def bronze_extract(t):
    extract = BronzeExtract("erp", "orders", lambda spark: t.orders, ["o_orderkey", "o_orderstatus"])
    path = extract.run(t.spark, scratch(t.spark, "lake"), EXTRACTED)
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "_source_system", "_extract_date", "_row_hash", "extract_date")


def _silver(rules=None):
    return SilverTransform("lines", required=["l_orderkey", "quantity"], drop_null=["l_shipdate"], fill={"quantity": 0.0, "flag": "NONE"},
                           derive={"amount": "round(quantity * l_extendedprice, 4)"},
                           dedupe_on=["l_orderkey", "l_linenumber"], dedupe_order=["l_shipdate"], rules=rules)


SILVER_SQL = GAPS_SQL + """, f AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, coalesce(quantity, 0) AS quantity,
  coalesce(flag, 'NONE') AS flag, tax, round(coalesce(quantity, 0) * l_extendedprice, 4) AS amount FROM gaps),
d AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST,
  l_suppkey DESC NULLS LAST, l_extendedprice DESC NULLS LAST, quantity DESC NULLS LAST, flag DESC NULLS LAST, tax DESC NULLS LAST) = 1)
"""


@query("silver_transform", SILVER_SQL + "SELECT l_orderkey, l_linenumber, quantity, flag, amount FROM d")
def silver_transform(t):
    return _silver().frame(gaps(t)).select("l_orderkey", "l_linenumber", "quantity", "flag", "amount")


@query("run_metadata", SILVER_SQL + """, r AS (SELECT * FROM d WHERE quantity > 45)
SELECT 'bronze' AS source, 'silver' AS layer, (SELECT count(*) FROM gaps) AS records_in, (SELECT count(*) FROM d) - (SELECT count(*) FROM r) AS records_out,
  (SELECT count(*) FROM r) AS records_rejected, (SELECT count(*) FROM gaps) - (SELECT count(*) FROM d) AS records_filtered, 'SUCCESS' AS status""")
def run_metadata(t):
    rules = RuleSet("lines", [R.in_range("quantity", None, 45)])
    row = _silver(rules).run(gaps(t), scratch(t.spark, "lake"))
    return row.select("source", "layer", "records_in", "records_out", "records_rejected", "records_filtered", "status")


@query("config_run", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-30 00:00:00' AND o_totalprice <= 300000""")
def config_run(t):
    config = {"name": "orders", "source": {"path": f"{t.folder}/orders.parquet"},
              "load": {"mode": "incremental", "column": "o_orderdate", "last_value": dt.datetime(1998, 6, 30)},
              "dedupe": {"keys": ["o_orderkey"], "order": ["o_orderdate"]}, "partition_by": ["o_orderstatus"],
              "quality": {"not_null": ["o_orderkey"], "range": {"o_totalprice": [0, 300000]}}}
    return flows.run_configured(t.spark, config, scratch(t.spark, "lake")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


RUNS_SQL = "WITH runs AS (SELECT user_id % 5 AS flow, event_type, ts, event_type = 'error' AS failed, value FROM events)"


def _log(t):
    return t.events.select((F.col("user_id") % 5).alias("flow"), "event_type", "ts", (F.col("event_type") == "error").alias("failed"), "value")


@query("run_reliability", RUNS_SQL + """
SELECT flow, count(*) AS runs, count(*) FILTER (NOT failed) AS successes, count(*) FILTER (failed) AS failures,
  round(100.0 * count(*) FILTER (NOT failed) / count(*), 6) AS success_rate, round(avg(value), 6) AS avg_duration,
  round(quantile_cont(value, 0.95), 6) AS p95_duration FROM runs GROUP BY flow""")
def run_reliability(t):
    out = flows.run_reliability(_log(t), ["flow"], F.col("failed"), "value")
    return out.withColumns({c: F.round(c, 6) for c in ("success_rate", "avg_duration", "p95_duration")})


@query("run_monthly_trend", """
WITH runs AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderstatus = 'P' AS failed, o_totalprice FROM orders)
SELECT y AS run_year, m AS run_month, count(*) AS runs, count(*) FILTER (NOT failed) AS successes, count(*) FILTER (failed) AS failures,
  round(100.0 * count(*) FILTER (NOT failed) / count(*), 6) AS success_rate, round(avg(o_totalprice), 4) AS avg_duration,
  round(quantile_cont(o_totalprice, 0.95), 4) AS p95_duration FROM runs GROUP BY 1, 2""")
def run_monthly_trend(t):
    log = t.orders.select(F.year("o_orderdate").cast("long").alias("run_year"), F.month("o_orderdate").cast("long").alias("run_month"),
                          "o_orderstatus", "o_totalprice")
    out = flows.run_reliability(log, ["run_year", "run_month"], F.col("o_orderstatus") == "P", "o_totalprice")
    return out.withColumns({"success_rate": F.round("success_rate", 6), "avg_duration": F.round("avg_duration", 4),
                            "p95_duration": F.round("p95_duration", 4)})


@query("run_recovery_time", RUNS_SQL + """
SELECT flow, count(*) AS failures, round(avg(value), 6) AS mttr FROM runs WHERE failed GROUP BY flow""")
def run_recovery_time(t):
    return flows.recovery_time(_log(t), ["flow"], F.col("failed"), "value").withColumn("mttr", F.round("mttr", 6))


@query("freshness_distribution", """
WITH h AS (SELECT value / 10 AS hours FROM events)
SELECT CASE WHEN hours < 1 THEN '<1h' WHEN hours < 2 THEN '1-2h' WHEN hours < 4 THEN '2-4h' ELSE '>4h' END AS freshness, count(*) AS records,
  count(*) FILTER (hours <= 4) AS within_sla, round(100.0 * count(*) / (SELECT count(*) FROM h), 6) AS share_pct FROM h GROUP BY 1""")
def freshness_distribution(t):
    return flows.freshness_distribution(t.events, F.col("value") / 10).withColumn("share_pct", F.round("share_pct", 6))


@query("stale_fallback", """
WITH d AS (SELECT max(CAST(ts AS DATE)) AS latest FROM events WHERE CAST(ts AS DATE) <= DATE '2024-02-02')
SELECT event_id, value, latest <> DATE '2024-02-02' AS is_stale FROM events, d WHERE CAST(ts AS DATE) = latest""")
def stale_fallback(t):
    return flows.stale_fallback(t.events, "ts", dt.date(2024, 2, 2)).select("event_id", "value", "is_stale")


@query("landed_file_checks", "SELECT count(*) AS row_count, 0::BIGINT AS rejected_files FROM orders")
def landed_file_checks(t):
    """Every landed file is checked; the checks of all files add up to the delivered rows."""
    folder = scratch(t.spark, "landing")
    for status in ("F", "O", "P"):
        t.orders.filter(F.col("o_orderstatus") == status).write.mode("append").parquet(folder)
    out = flows.landed_file_checks(t.spark, folder, "*.parquet", ["o_orderkey", "o_orderdate"], (0, 1_000_000_000_000))
    return out.agg(F.sum("row_count").alias("row_count"), F.count_if(~F.col("row_count_ok") | ~F.col("has_content")).alias("rejected_files"))


def _landed(t):
    """Three deliveries of orders in folders of their own, one without a column, one all NULL in it, and a broken file."""
    folder = scratch(t.spark, "landing")
    for status, frame in (("F", t.orders), ("O", t.orders.drop("o_orderdate")), ("P", t.orders.withColumn("o_orderdate", F.lit(None).cast("timestamp_ntz")))):
        frame.filter(F.col("o_orderstatus") == status).coalesce(1).write.parquet(f"{folder}/{status}")
    t.orders.limit(5).select(F.col("o_orderpriority").alias("value")).coalesce(1).write.text(f"{folder}/X")
    fs, path = filesystem(t.spark, f"{folder}/X")
    for status in fs.listStatus(path):
        if status.getPath().getName().endswith(".txt"):
            fs.rename(status.getPath(), path.suffix("/orders.parquet"))
    return folder


@query("landed_file_rows", """
SELECT o_orderstatus AS delivery, count(*) AS row_count, true AS has_content, count(*) >= 10 AS row_count_ok, o_orderstatus <> 'O' AS columns_ok,
  count(*) >= 10 AND o_orderstatus <> 'O' AS accepted FROM orders GROUP BY 1
UNION ALL SELECT 'X', 0, true, false, false, false""")
def landed_file_rows(t):
    """One row per landed file, with what each check found: a column that is all NULL is there, a broken file is rejected."""
    out = flows.landed_file_checks(t.spark, _landed(t), "*.parquet", ["o_orderkey", "o_orderdate"], (10, 1_000_000_000))
    return out.select(F.element_at(F.split("path", "/"), -2).alias("delivery"), "row_count", "has_content", "row_count_ok", "columns_ok", "accepted")


@query("file_footers", """
SELECT o_orderstatus AS delivery, true AS readable, count(*) AS row_count, CASE WHEN o_orderstatus = 'O' THEN 5 ELSE 6 END::INTEGER AS columns FROM orders GROUP BY 1
UNION ALL SELECT 'X', false, NULL, NULL""")
def file_footers(t):
    """Rows and columns of each file by its own footer."""
    out = parquet_footers(t.spark, _landed(t))
    return out.select(F.element_at(F.split("path", "/"), -2).alias("delivery"), "readable", "row_count", F.size("columns").alias("columns"))


@query("set_aside_files", "SELECT 'X' AS delivery, 'orders.parquet' AS file_name, count(*) > 0 AS set_aside FROM orders")
def set_aside_files(t):
    """Landed files that cannot be read, by their full path."""
    out = unreadable_files(t.spark, _landed(t))
    return out.select(F.element_at(F.split("path", "/"), -2).alias("delivery"), "file_name", F.col("error").isNotNull().alias("set_aside"))
