"""Writers: every query writes to the shared scratch folder, reads the result back and returns it."""

import datetime as dt

from pyspark.sql import functions as F

from queries.registry import query
from tidelake.session import scratch
from tidelake.sinks import tables
from tidelake.sources.catalog import Lakehouse

MERGE_CTE = """
WITH existing AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
incoming AS (SELECT o_orderkey, 'M' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders
             WHERE o_orderdate >= TIMESTAMP '1999-07-01')
"""
MERGED = MERGE_CTE + """
SELECT * FROM existing WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming) UNION ALL SELECT * FROM incoming"""


def _versions(t):
    """An existing table, and a later delivery that overlaps it by half a year."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    existing = t.orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(*columns)
    new = t.orders.filter(F.col("o_orderdate") >= F.lit("1999-07-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.lit("M").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return existing, new


@query("merge_upsert", MERGED)
def merge_upsert(t):
    return tables.merge_upsert(*_versions(t), ["o_orderkey"])


@query("merge_into_table", MERGED)
def merge_into_table(t):
    """The same upsert on a stored table partitioned by status; rows move between partitions."""
    existing, new = _versions(t)
    path = scratch(t.spark, "merge-target")
    tables.write_table(existing, path, ["o_orderstatus"])
    tables.merge_into_table(path, new, ["o_orderkey"], ["o_orderstatus"])
    return t.spark.read.parquet(path)


LEVELS_SQL = """
WITH existing AS (SELECT *, year(o_orderdate) AS y, o_orderpriority AS p FROM orders WHERE o_orderkey % 3 <> 0),
incoming AS (SELECT o_orderkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, {year} AS y, o_orderpriority AS p FROM orders WHERE {chosen})
SELECT o_orderkey, o_orderstatus, o_totalprice, y::INTEGER AS y, p FROM existing WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, y::INTEGER, p FROM incoming"""


def _two_levels(t, year, chosen):
    """Two thirds of the orders stored by year and priority, then a delivery merged into them."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    path = scratch(t.spark, "merge-levels")
    stored = t.orders.filter("o_orderkey % 3 <> 0").select(*columns, F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p"))
    tables.write_table(stored, path, ["y", "p"])
    new = t.orders.filter(chosen).select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"),
                                         year.cast("int").alias("y"), F.col("o_orderpriority").alias("p"))
    tables.merge_into_table(path, new, ["o_orderkey"], ["y", "p"])
    return t.spark.read.schema(new.schema).parquet(path)


@query("merge_two_level", LEVELS_SQL.format(year="year(o_orderdate)", chosen="o_orderdate >= TIMESTAMP '1999-07-01'"))
def merge_two_level(t):
    """A delivery of updated and new orders into a table of two partition levels."""
    return _two_levels(t, F.year("o_orderdate"), "o_orderdate >= TIMESTAMP_NTZ '1999-07-01'")


@query("merge_moved_keys", LEVELS_SQL.format(year="2050", chosen="o_orderstatus = 'P' OR year(o_orderdate) = 1996"))
def merge_moved_keys(t):
    """Merged orders leave their partitions for those of another year; the year 1996 is emptied."""
    return _two_levels(t, F.lit(2050), "o_orderstatus = 'P' OR year(o_orderdate) = 1996")


@query("merge_counts", MERGE_CTE + """
SELECT (SELECT count(*) FROM existing WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)) AS unchanged,
       (SELECT count(*) FROM incoming WHERE o_orderkey IN (SELECT o_orderkey FROM existing)) AS updated,
       (SELECT count(*) FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM existing)) AS inserted""")
def merge_counts(t):
    return tables.merge_counts(*_versions(t), ["o_orderkey"])


@query("anti_inserts", MERGE_CTE + "SELECT * FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM existing)")
def anti_inserts(t):
    existing, new = _versions(t)
    return new.join(existing.select("o_orderkey"), "o_orderkey", "left_anti")


@query("anti_unchanged", MERGE_CTE + "SELECT * FROM existing WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming)")
def anti_unchanged(t):
    existing, new = _versions(t)
    return existing.join(new.select("o_orderkey"), "o_orderkey", "left_anti")


@query("partition_guard", """
SELECT count(*) AS partitions FROM (SELECT DISTINCT l_returnflag, year(l_shipdate) FROM lineitem)""")
def partition_guard(t):
    df = t.lineitem.select("l_returnflag", F.year("l_shipdate").alias("ship_year"))
    tables.check_partitions(df, ["l_returnflag", "ship_year"])
    return tables.partition_count(df, ["l_returnflag", "ship_year"])


@query("append_partitions", """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def append_partitions(t):
    path = scratch(t.spark, "append")
    df = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    tables.write_table(df, path, ["o_orderpriority"])
    again = t.orders.filter("o_orderstatus = 'P'").select(*df.columns)
    tables.append_partitions(again, path, ["o_orderpriority"])
    return t.spark.read.parquet(path)


@query("bronze_append", """
SELECT event_id, value, DATE '2024-02-01' AS extract_date FROM events
UNION ALL SELECT event_id, value, DATE '2024-02-02' FROM events WHERE event_type = 'error'""")
def bronze_append(t):
    root = scratch(t.spark, "lake")
    df = t.events.select("event_id", "value")
    tables.bronze_append(df, root, "events", dt.date(2024, 2, 1))
    path = tables.bronze_append(t.events.filter("event_type = 'error'").select("event_id", "value"), root, "events",
                                dt.date(2024, 2, 2))
    return t.spark.read.parquet(path)


@query("bronze_day_overwrite", """
SELECT event_id, value, DATE '2024-02-01' AS extract_date FROM events
UNION ALL SELECT event_id, value, DATE '2024-02-02' FROM events WHERE event_type = 'error'""")
def bronze_day_overwrite(t):
    """The second day is delivered twice; the rerun replaces it and leaves the first day alone."""
    root = scratch(t.spark, "lake")
    df = t.events.select("event_id", "value")
    tables.bronze_replace_day(df, root, "events", dt.date(2024, 2, 1))
    tables.bronze_replace_day(df, root, "events", dt.date(2024, 2, 2))
    errors = t.events.filter("event_type = 'error'").select("event_id", "value")
    path = tables.bronze_replace_day(errors, root, "events", dt.date(2024, 2, 2))
    return t.spark.read.parquet(path)


@query("silver_write", "SELECT * FROM customer")
def silver_write(t):
    return t.spark.read.parquet(tables.write_silver(t.customer, scratch(t.spark, "lake"), "customer"))


@query("gold_write", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem")
def gold_write(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    return t.spark.read.parquet(tables.write_gold(df, scratch(t.spark, "lake"), "lines", ["l_returnflag"]))


@query("export_query", "SELECT n_regionkey, n_name, n_nationkey FROM nation, region WHERE n_regionkey = r_regionkey")
def export_query(t):
    lake = Lakehouse(t.spark).register_frame("exp_nation", t.nation).register_frame("exp_region", t.region)
    path = scratch(t.spark, "export")
    lake.export_query("SELECT n_regionkey, n_name, n_nationkey FROM exp_nation JOIN exp_region "
                      "ON n_regionkey = r_regionkey", path, "csv")
    return t.spark.read.option("header", True).schema("n_regionkey int, n_name string, n_nationkey int").csv(path)


@query("aggregate_table", """
SELECT l_returnflag, count(*) AS line_count, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1""")
def aggregate_table(t):
    lake = Lakehouse(t.spark).register_frame("agg_lines", t.lineitem)
    return lake.aggregate_table("agg_by_flag", "SELECT l_returnflag, count(*) AS line_count, sum(l_quantity) AS quantity "
                                "FROM agg_lines GROUP BY l_returnflag", scratch(t.spark, "aggregate"))


@query("reprocess_dates", """
SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN value + 100 ELSE value END AS value,
       CAST(ts AS DATE) AS day FROM events""")
def reprocess_dates(t):
    path = scratch(t.spark, "silver")
    df = t.events.select("event_id", "value", F.to_date("ts").alias("day"))
    tables.write_table(df, path, ["day"])
    fixed = df.withColumn("value", F.col("value") + 100)
    tables.overwrite_dates(fixed, path, "day", F.col("day") >= F.lit(dt.date(2024, 1, 20)))
    return t.spark.read.parquet(path)


@query("reprocess_in_place", """
SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN value + 100 ELSE value END AS value,
       CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-22'""")
def reprocess_in_place(t):
    """Days rewritten from the table itself; all rows of one of them are rejected, which empties it."""
    path = scratch(t.spark, "silver")
    tables.write_table(t.events.select("event_id", "value", F.to_date("ts").alias("day")), path, ["day"])
    stored = t.spark.read.parquet(path)
    fixed = stored.filter(F.col("day") != F.lit(dt.date(2024, 1, 22))).withColumn("value", F.col("value") + 100)
    tables.overwrite_dates(fixed, path, "day", F.col("day") >= F.lit(dt.date(2024, 1, 20)))
    return t.spark.read.parquet(path)


QUARANTINE_SQL = """
SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'balance_positive' END,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'segment_allowed' END)
  AS failed_rules FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'MACHINERY'"""


@query("quarantine_split", QUARANTINE_SQL)
def quarantine_split(t):
    _, bad = tables.quarantine_split(t.customer, {"balance_positive": F.col("c_acctbal") < 0,
                                                  "segment_allowed": F.col("c_mktsegment") == "MACHINERY"})
    return bad.select("c_custkey", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query("write_stats", """
SELECT count(*) AS records_written, 'l_returnflag' AS partition_columns, 'SUCCESS' AS status FROM lineitem""")
def write_stats(t):
    stats = tables.write_with_stats(t.lineitem, scratch(t.spark, "stats"), ["l_returnflag"])
    return stats.select("records_written", "partition_columns", "status")


@query("file_manifest")
def file_manifest(t):
    path = scratch(t.spark, "manifest")
    tables.write_table(t.orders, path, ["o_orderstatus"])
    return tables.file_manifest(t.spark, path)


@query("partition_by_ymd", """
SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day FROM events""")
def partition_by_ymd(t):
    path = scratch(t.spark, "ymd")
    tables.write_table(tables.with_ymd(t.events.select("event_id", "ts"), "ts"), path, ["year", "month", "day"])
    return t.spark.read.parquet(path).select("event_id", *[F.col(c).cast("long").alias(c)
                                                           for c in ("year", "month", "day")])


@query("retention_keep", """
SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - INTERVAL 14 DAY""")
def retention_keep(t):
    df = t.events.select("event_id", F.to_date("ts").alias("day"))
    path = scratch(t.spark, "retention")
    tables.write_table(df, path, ["day"])
    tables.drop_expired_partitions(t.spark, path, "day", dt.date(2024, 1, 30), 14)
    return tables.retention_keep(t.spark.read.parquet(path), "day", dt.date(2024, 1, 30), 14)
