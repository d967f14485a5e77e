"""Scans, sources and registered tables."""

import datetime as dt

from pyspark.sql import functions as F

from queries.registry import query
from tidelake.operators.relate import null_profile
from tidelake.plans.dimensional import dim_location
from tidelake.session import scratch
from tidelake.sinks.tables import export, write_table
from tidelake.sources import files
from tidelake.sources.catalog import Lakehouse, create_analytics_db, query_lakehouse


@query("scan_parquet", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_parquet(t):
    path = scratch(t.spark, "orders")
    write_table(t.orders, path, ["o_orderstatus"])
    return files.scan_parquet(t.spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("scan_csv_roundtrip", "SELECT * FROM customer")
def scan_csv_roundtrip(t):
    path = scratch(t.spark, "customer")
    export(t.customer, path, "csv")
    return files.scan_csv(t.spark, path, t.customer.schema)


@query("scan_json_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_json_roundtrip(t):
    path = scratch(t.spark, "events")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    t.events.write.option("timestampNTZFormat", micros).json(path)
    return files.scan_json(t.spark, path, t.events.schema, timestampNTZFormat=micros)


@query("scan_by_suffix", """
SELECT f.fmt, s.row_count, s.total_size
FROM (SELECT count(*) AS row_count, CAST(sum(p_size) AS BIGINT) AS total_size FROM part) s
CROSS JOIN (VALUES ('.parquet'), ('.csv'), ('.json'), ('.dat')) f(fmt)""")
def scan_by_suffix(t):
    base = scratch(t.spark, "part")
    t.part.write.parquet(f"{base}/part.parquet")
    t.part.write.option("header", True).csv(f"{base}/part.csv")
    t.part.write.json(f"{base}/part.json")
    t.part.write.option("sep", "|").option("header", True).csv(f"{base}/part.dat")
    pipes = {".dat": lambda spark, path: files.scan_csv(spark, path, sep="|")}
    parts = [files.scan_by_suffix(t.spark, f"{base}/part{s}", pipes).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("p_size").cast("long").alias("total_size"))
        .select(F.lit(s).alias("fmt"), "row_count", "total_size") for s in (".parquet", ".csv", ".json", ".dat")]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("latest_landed_file", "SELECT 'P' AS delivery, count(*) AS row_count FROM orders WHERE o_orderstatus = 'P'")
def latest_landed_file(t):
    """Three deliveries land one after the other; the newest complete file tells which of them to read."""
    folder = scratch(t.spark, "drop")
    for status in ("F", "O", "P"):
        t.orders.filter(F.col("o_orderstatus") == status).write.parquet(f"{folder}/{status}")
    newest = files.latest_landed_file(t.spark, folder, "*.parquet").first()["path"]
    delivery = newest.rsplit("/", 2)[-2]
    return files.scan_parquet(t.spark, f"{folder}/{delivery}").agg(
        F.lit(delivery).alias("delivery"), F.count(F.lit(1)).alias("row_count"))


@query("incremental_scan", """
SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""")
def incremental_scan(t):
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return files.incremental(t.events, "ts", mark).select("event_id", "ts", "value")


@query("next_high_watermark", "SELECT event_type, max(ts) AS high_mark FROM events GROUP BY event_type")
def next_high_watermark(t):
    return t.events.groupBy("event_type").agg(F.max("ts").alias("high_mark"))


TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
         ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("table_schema", " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{d}' AS data_type, NULL::INTEGER AS numeric_precision, "
    f"true AS is_nullable, count(*) - count({c}) AS null_count FROM orders" for i, (c, d) in enumerate(TYPES, 1)))
def table_schema(t):
    """Declared schema next to the nulls found in the rows."""
    return files.table_schema(t.orders).join(null_profile(t.orders).select("column_name", "null_count"), "column_name")


@query("table_row_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
    for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")))
def table_row_counts(t):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return files.row_counts({n: getattr(t, n) for n in names})


ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
              "pages", "benchmark", "labels", "conversations")


@query("table_row_counts_all", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ALL_TABLES))
def table_row_counts_all(t):
    """All given tables; the SQL of ``table_row_counts`` has the first eight."""
    return files.row_counts({n: getattr(t, n) for n in ALL_TABLES})


def _pages(t):
    """Events as JSON pages of up to 100 rows; some pages hold a single object, some no data at all."""
    rows = t.events.select((F.col("event_id") / 100).cast("long").alias("page"),
                           F.struct("event_id", "user_id", "event_type", "value").alias("r"))
    grouped = rows.groupBy("page").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    last = F.col("page") % 10
    body = (F.when(last == 3, F.to_json(F.struct(F.struct(F.col("rs")[0].alias("data")).alias("results"))))
            .when(last == 7, F.to_json(F.struct(F.size("rs").alias("total"))))
            .otherwise(F.to_json(F.struct(F.struct(F.col("rs").alias("data")).alias("results")))))
    return grouped.select("page", body.alias("body"))


@query("json_envelope_rows", """
WITH paged AS (SELECT *, event_id // 100 AS page FROM events)
SELECT event_id, user_id, event_type, value FROM paged WHERE page % 10 NOT IN (3, 7)
UNION ALL
SELECT event_id, user_id, event_type, value FROM paged WHERE page % 10 = 3 AND event_id % 100 = 0""")
def json_envelope_rows(t):
    return files.envelope_rows_typed(_pages(t), "body", "results.data",
                                     "event_id bigint, user_id bigint, event_type string, value double")


@query("page_union", "SELECT event_id, user_id, event_type, value FROM events")
def page_union(t):
    """All landed page files read as one table, the rows unnested along the dotted path."""
    path = scratch(t.spark, "pages")
    rows = t.events.select((F.col("event_id") / 100).cast("long").alias("page"),
                           F.struct("event_id", "user_id", "event_type", "value").alias("r"))
    pages = rows.groupBy("page").agg(F.collect_list("r").alias("data"), F.count(F.lit(1)).alias("total"))
    pages.select(F.struct("data", "total").alias("results")).write.json(path)
    return files.envelope_rows(files.scan_json(t.spark, path), "results.data").select(
        "event_id", "user_id", "event_type", "value")


@query("scan_as_strings", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part""")
def scan_as_strings(t):
    path = scratch(t.spark, "part")
    export(t.part, path, "csv")
    return files.scan_as_strings(t.spark, path).select("p_partkey", "p_name", "p_size")


@query("register_frame", """
SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def register_frame(t):
    lake = Lakehouse(t.spark).register_frame("reg_orders", t.orders)
    return lake.query("SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total "
                      "FROM reg_orders GROUP BY o_orderpriority")


@query("register_parquet", """
SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def register_parquet(t):
    path = scratch(t.spark, "orders")
    write_table(t.orders, path, ["o_orderstatus"])
    lake = Lakehouse(t.spark).register_parquet("reg_orders_by_status", path)
    return lake.query("SELECT o_orderpriority, count(*) AS orders FROM reg_orders_by_status "
                      "WHERE o_orderstatus = 'F' GROUP BY o_orderpriority")


def _gold(t):
    gold = scratch(t.spark, "gold")
    write_table(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                  "l_returnflag"), f"{gold}/facts/gold_lines", ["l_returnflag"], codec="zstd")
    write_table(t.part, f"{gold}/dimensions/gold_parts", codec="zstd")
    write_table(dim_location(t.supplier, t.nation, t.region), f"{gold}/dimensions/gold_places", codec="zstd")
    return gold


@query("gold_layer_load", """
SELECT 'gold_lines' AS table_name, count(*) AS row_count, 6 AS column_count FROM lineitem
UNION ALL SELECT 'gold_parts', count(*), 6 FROM part
UNION ALL SELECT 'gold_places', count(*), 5 FROM supplier""")
def gold_layer_load(t):
    lake = Lakehouse(t.spark)
    lake.load_gold(_gold(t))
    return lake.table_stats()


@query("query_lakehouse", """
SELECT p_type, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_type""")
def query_gold(t):
    return query_lakehouse(t.spark, _gold(t), """
        SELECT p_type, sum(l_quantity) AS quantity FROM gold_lines JOIN gold_parts ON l_partkey = p_partkey
        GROUP BY p_type""", ["gold_lines", "gold_parts"])


@query("analytics_db", """
SELECT 'gold_lines' AS table_name, 'facts' AS kind, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'gold_parts', 'dimensions', count(*) FROM part
UNION ALL SELECT 'gold_places', 'dimensions', count(*) FROM supplier""")
def analytics_db(t):
    return create_analytics_db(t.spark, _gold(t), "tidelake_analytics", scratch(t.spark, "database"))


@query("table_stats", """
SELECT 'stat_nation' AS table_name, count(*) AS row_count, 3 AS column_count FROM nation
UNION ALL SELECT 'stat_orders', count(*), 6 FROM orders""")
def table_stats(t):
    lake = Lakehouse(t.spark).register_frame("stat_orders", t.orders).register_frame("stat_nation", t.nation)
    return lake.table_stats()


@query("table_info", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, '{d}' AS data_type, count(*) AS row_count FROM orders" for c, d in TYPES))
def table_info(t):
    info = Lakehouse(t.spark).register_frame("info_orders", t.orders).table_info("info_orders")
    return info.select("col_name", "data_type", t.orders.agg(F.count(F.lit(1))).scalar().alias("row_count"))


@query("sql_parameterised", """
SELECT event_type, count(*) AS events FROM events
WHERE value >= 10.0 AND ts >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY event_type""")
def sql_parameterised(t):
    lake = Lakehouse(t.spark).register_frame("param_events", t.events)
    return lake.query("SELECT event_type, count(*) AS events FROM param_events "
                      "WHERE value >= :low AND ts >= CAST(:since AS timestamp_ntz) GROUP BY event_type",
                      {"low": 10.0, "since": "2024-01-10 00:00:00"})


@query("bronze_metadata", """
SELECT o_orderkey, 'erp' AS _source_system, TIMESTAMP '2024-03-01 06:30:00' AS _extract_timestamp,
       '2024-03-01' AS _extract_date, 'orders.parquet' AS _file_name FROM orders""")
def bronze_metadata(t):
    df = t.orders.select("o_orderkey", F.col("_metadata.file_name").alias("__file"))
    out = files.with_lineage(df, "erp", dt.datetime(2024, 3, 1, 6, 30), F.col("__file"))
    return out.drop("__file")


@query("row_hash", """
SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus)
       AS _row_hash FROM orders""")
def row_hash(t):
    return files.with_row_hash(t.orders).select("o_orderkey", "_row_hash")
