"""Structured Streaming forms of the scheduled loads: ingest, upsert, re-delivery dedupe, volume check.

Every query runs with ``availableNow``: it drains what has landed, commits its checkpoint and stops, so the same
code serves an hourly job and a continuous one.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.text import row_hash
from tidelake.sinks.tables import merge_into_table


def landed_files(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                 pattern: str = "*", files_per_batch: int = 1000) -> DataFrame:
    """Stream of newly landed files."""
    return (spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_per_batch).load(folder))


def _drain(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_to_bronze(stream: DataFrame, path: str, checkpoint: str, system: str, date_column: str) -> None:
    """Append new rows to Bronze exactly once, partitioned by date, with source system and row hash."""
    out = stream.withColumns({"_source_system": F.lit(system), "_row_hash": row_hash(stream.columns),
                              "extract_date": F.to_date(date_column)})
    _drain(out.writeStream.format("parquet").option("path", path).partitionBy("extract_date").outputMode("append"),
           checkpoint)


def stream_upsert(stream: DataFrame, path: str, checkpoint: str, on: Sequence[str],
                  reduce_batch: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = (),
                  mode: str = "append") -> None:
    """Upsert every micro-batch into a table. ``reduce_batch`` leaves one row per key.

    With ``mode`` "update" a stream of counts hands on what changed, windows that are still open included.

    A batch that is run again after a failure merges the same rows once more, which changes nothing.
    """
    def merge(batch: DataFrame, _: int) -> None:
        merge_into_table(path, reduce_batch(batch), on, partition_by)

    _drain(stream.writeStream.foreachBatch(merge).outputMode(mode), checkpoint)


def deduplicated(stream: DataFrame, ts: str, columns: Sequence[str], late_bound: str) -> DataFrame:
    """Drop re-delivered rows by hash; state is kept only for ``late_bound`` behind the watermark."""
    timed = stream.withColumns({"event_time": F.col(ts).cast("timestamp"), "_row_hash": row_hash(columns)})
    return timed.withWatermark("event_time", late_bound).dropDuplicatesWithinWatermark(["_row_hash"])


def volume_per_window(stream: DataFrame, ts: str, width: str, late_bound: str, low: int, high: int) -> DataFrame:
    """Rows per tumbling window with a status against the expected range; in append mode emitted once the window
    closes, in update mode whenever it changes."""
    timed = stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", late_bound)
    counts = timed.groupBy(F.window("event_time", width)).agg(F.count(F.lit(1)).alias("records"))
    n = F.col("records")
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "records",
                         F.when(n < low, "missing").when(n > high, "volatility").otherwise("ok").alias("status"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    _drain(stream.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)
