"""Streaming forms of the scheduled loads, drained with ``availableNow``."""

from pyspark.sql import functions as F

from queries.registry import query
from tidelake.session import scratch
from tidelake.streaming import ingest


def _events(t, **options):
    return ingest.landed_files(t.spark, t.folder, t.events.schema, pattern="events.parquet", **options)


@query("stream_ingest", """
SELECT event_id, event_type, value, 'crm' AS _source_system, CAST(ts AS DATE) AS extract_date,
  md5(CAST(event_id AS VARCHAR) || '|' || event_type) AS row_check FROM events""")
def stream_ingest(t):
    base = scratch(t.spark, "stream")
    ingest.stream_to_bronze(_events(t), f"{base}/bronze", f"{base}/checkpoint", "crm", "ts")
    out = t.spark.read.parquet(f"{base}/bronze")
    return out.select("event_id", "event_type", "value", "_source_system", "extract_date",
                      F.md5(F.concat_ws("|", F.col("event_id").cast("string"), "event_type")).alias("row_check"))


@query("stream_merge", """
SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value, CAST(ts AS DATE) AS day FROM events""")
def stream_merge(t):
    """First all events land, later a corrected delivery of the errors; the restarted stream upserts only the latter."""
    base = scratch(t.spark, "stream")

    def arrive(delivery):
        delivery.write.mode("append").parquet(f"{base}/landing")
        stream = ingest.landed_files(t.spark, f"{base}/landing", t.events.schema, pattern="*.parquet")
        ingest.stream_upsert(stream, f"{base}/silver", f"{base}/checkpoint", ["event_id"],
                             lambda batch: batch.select("event_id", "event_type", "value", F.to_date("ts").alias("day")), ["day"])

    arrive(t.events)
    arrive(t.events.filter("event_type = 'error'").withColumn("value", F.col("value") + 1))
    return t.spark.read.parquet(f"{base}/silver")


@query("stream_dedupe", """
SELECT event_id, md5(CAST(event_id AS VARCHAR) || '|' || event_type || '|' || CAST(user_id AS VARCHAR)) AS _row_hash FROM events""")
def stream_dedupe(t):
    """The same events land twice; every row comes out once."""
    base = scratch(t.spark, "stream")
    for _ in range(2):
        t.events.write.mode("append").parquet(f"{base}/landing")
    stream = ingest.landed_files(t.spark, f"{base}/landing", t.events.schema, pattern="*.parquet")
    unique = ingest.deduplicated(stream, "ts", ["event_id", "event_type", "user_id"], "60 days")
    ingest.append_to(unique.select("event_id", "_row_hash"), f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/out")


@query("stream_volume", """
WITH w AS (SELECT date_trunc('hour', ts) AS window_start, count(*) AS records FROM events GROUP BY 1)
SELECT window_start, records, CASE WHEN records < 10 THEN 'missing' WHEN records > 20 THEN 'volatility' ELSE 'ok' END AS status FROM w
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)""")
def stream_volume(t):
    """A window is emitted once the watermark has passed its end; the last, still open hour is not."""
    base = scratch(t.spark, "stream")
    counts = ingest.volume_per_window(_events(t), "ts", "1 hour", "0 seconds", 10, 20)
    ingest.append_to(counts, f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/out")


@query("stream_volume_open", """
WITH w AS (SELECT date_trunc('hour', ts) AS window_start, count(*) AS records FROM events GROUP BY 1)
SELECT window_start, records, CASE WHEN records < 10 THEN 'missing' WHEN records > 20 THEN 'volatility' ELSE 'ok' END AS status FROM w""")
def stream_volume_open(t):
    """Every window, the last, still open hour included: counts are upserted whenever they change."""
    base = scratch(t.spark, "stream")
    counts = ingest.volume_per_window(_events(t), "ts", "1 hour", "0 seconds", 10, 20)
    ingest.stream_upsert(counts, f"{base}/out", f"{base}/checkpoint", ["window_start"], lambda batch: batch, mode="update")
    return t.spark.read.parquet(f"{base}/out")
