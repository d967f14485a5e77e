"""End-to-end table flows: extract to Bronze, transform to Silver, configuration-driven runs, run metadata."""

from __future__ import annotations

import datetime as dt
import json
import time
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import ledger
from tidelake.operators.cleaning import deduplicate, deduplicate_in_ledger, drop_nulls, fill_nulls, without_nulls
from tidelake.operators.quantiles import grouped_quantile
from tidelake.operators.split_window import null_safe_join
from tidelake.quality.rules import RuleSet
from tidelake.quality.schema import TableSpec, enforce, require_columns
from tidelake.sinks.tables import bronze_append, bronze_replace_day, layer_path, write_table
from tidelake.session import materialise
from tidelake.sources.files import file_listing, incremental, parquet_footers, with_lineage, with_row_hash


@dataclass
class BronzeExtract:
    """Extract → lineage columns → row hash → Bronze. ``source`` is lazy; Spark retries its tasks."""

    system: str
    table: str
    source: Callable[[SparkSession], DataFrame]
    hash_columns: Sequence[str] | None = None
    file_name: Column | None = None

    def frame(self, spark: SparkSession, extracted_at: dt.datetime) -> DataFrame:
        return with_row_hash(with_lineage(self.source(spark), self.system, extracted_at, self.file_name),
                             self.hash_columns)

    def run(self, spark: SparkSession, root: str, extracted_at: dt.datetime, replace: bool = True) -> str:
        write = bronze_replace_day if replace else bronze_append
        return write(self.frame(spark, extracted_at), root, self.table, extracted_at.date())


@dataclass
class SilverTransform:
    """Schema → NULLs → business step → dedupe, as one lazy plan.

    ``derive`` adds row-wise columns. ``step`` may be any function of the frame; with one, rows in are counted by a scan of
    their own, as it may change what a row is.
    """

    table: str
    required: Sequence[str] = ()
    spec: TableSpec | None = None
    drop_null: Sequence[str] = ()
    fill: Mapping[str, Any] = field(default_factory=dict)
    derive: Mapping[str, Column | str] = field(default_factory=dict)
    step: Callable[[DataFrame], DataFrame] | None = None
    dedupe_on: Sequence[str] = ()
    dedupe_keep: str = "last"
    dedupe_order: Sequence[str] | None = None
    rules: RuleSet | None = None

    def frame(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.required)
        if self.spec:
            df = enforce(df, self.spec)
        if self.drop_null:
            df = drop_nulls(df, self.drop_null)
        if self.fill:
            df = fill_nulls(df, self.fill)
        df = self._derived(df)
        if self.step:
            df = df.transform(self.step)
        if self.dedupe_on:
            df = deduplicate(df, self.dedupe_on, self.dedupe_keep, self.dedupe_order)
        return df

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Transformed rows that pass the rules, and the quarantined ones."""
        out = self.frame(df)
        return self.rules.split(out) if self.rules else (out, None)

    def _derived(self, df: DataFrame) -> DataFrame:
        return df.withColumns({n: F.expr(c) if isinstance(c, str) else c for n, c in self.derive.items()}) if self.derive else df

    def _with_ledger(self, df: DataFrame) -> DataFrame:
        """:meth:`frame` with the dropped rows as ghosts: 0 for NULLs, 1 for repeats."""
        require_columns(df, self.required)
        out = ledger.opened(enforce(df, self.spec) if self.spec else df)
        if self.drop_null:
            out = ledger.dropped(out, without_nulls(out, self.drop_null), 0)
        if self.fill:
            out = fill_nulls(out, self.fill)
        out = self._derived(out)
        return deduplicate_in_ledger(out, self.dedupe_on, self.dedupe_keep, self.dedupe_order, 1) if self.dedupe_on else out

    def run(self, df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write Silver (and quarantine), then give the run metadata row.

        The source is read once: good rows, quarantined rows and the counts of what was dropped come from one written
        table in the shared folder.
        """
        started = time.monotonic()
        path = layer_path(root, "silver", self.table)
        if self.step:
            marked, n_in = materialise(self.frame(df), "silver"), df.agg(F.count(F.lit(1))).scalar()
        else:
            every = materialise(self._with_ledger(df), "silver")
            n_in = every.agg(F.coalesce(F.sum(ledger.WEIGHT), F.lit(0).cast("long"))).scalar()
            marked = every.filter(ledger.alive()).select(*ledger.data_columns(every))
        good, bad = self.rules.split(marked) if self.rules else (marked, None)
        write_table(good, path, partition_by)
        rejected = None
        if bad is not None:
            rejected = layer_path(root, "silver", f"_quarantine_{self.table}")
            write_table(bad, rejected)
        spark = df.sparkSession
        return run_metadata(df, spark.read.schema(good.schema).parquet(path), "bronze", path, "silver",
                            spark.read.schema(bad.schema).parquet(rejected) if rejected else None,
                            round(time.monotonic() - started, 3), n_in)


def completeness(df: DataFrame) -> Column:
    """Share of filled cells, as an aggregate over the frame's columns."""
    filled = reduce(lambda a, b: a + b, [F.count(F.col(c)) for c in df.columns])
    return F.coalesce(F.try_divide(filled, F.count(F.lit(1)) * len(df.columns)), F.lit(0.0))


def run_metadata(source: DataFrame, target: DataFrame, source_name: str, target_name: str, layer: str,
                 rejected: DataFrame | None = None, seconds: float = 0.0, records_in: Column | None = None) -> DataFrame:
    """Counts in, out, filtered and rejected with the completeness score, from what was read and written.

    ``records_in`` saves the scan of ``source`` where the number of its rows is known.
    """
    out = target.agg(F.count(F.lit(1)).alias("records_out"), completeness(target).alias("quality_score"))
    n_in = records_in if records_in is not None else source.agg(F.count(F.lit(1))).scalar()
    n_bad = rejected.agg(F.count(F.lit(1))).scalar() if rejected is not None else F.lit(0).cast("long")
    counts = out.select(F.lit(source_name).alias("source"), F.lit(target_name).alias("target"),
                        F.lit(layer).alias("layer"), n_in.alias("records_in"), "records_out",
                        n_bad.alias("records_rejected"), F.lit(seconds).alias("duration_seconds"),
                        F.lit("SUCCESS").alias("status"), "quality_score")
    return counts.withColumn("records_filtered",
                             F.col("records_in") - F.col("records_out") - F.col("records_rejected"))


def append_run_log(rows: DataFrame, root: str) -> str:
    """Add run metadata rows to the run log, partitioned by layer; the log feeds :func:`run_reliability`."""
    path = layer_path(root, "silver", "_run_log")
    write_table(rows.withColumn("logged_at", F.current_timestamp()), path, ["layer"], mode="append", max_partitions=None)
    return path


def run_configured(spark: SparkSession, config: Mapping[str, Any] | str, root: str) -> DataFrame:
    """Run a flow described by a mapping or JSON text and return the written table.

    Keys: ``name``, ``source`` (``path``, ``format``), ``load`` (``mode`` full or incremental, ``column``,
    ``last_value``), ``fill``, ``dedupe`` (``keys``, ``order``), ``quality`` (rules) and ``partition_by``.
    """
    cfg = json.loads(config) if isinstance(config, str) else dict(config)
    source = cfg["source"]
    df = spark.read.format(source.get("format", "parquet")).load(source["path"])
    load = cfg.get("load", {"mode": "full"})
    if load["mode"] == "incremental":
        df = incremental(df, load["column"], load.get("last_value"))
    elif load["mode"] != "full":
        raise ValueError(f"unknown load mode {load['mode']}")
    dedupe = cfg.get("dedupe", {})
    quality = cfg.get("quality")
    flow = SilverTransform(cfg["name"], fill=cfg.get("fill", {}), dedupe_on=dedupe.get("keys", ()),
                           dedupe_order=dedupe.get("order"),
                           rules=RuleSet.from_config(quality) if quality else None)
    flow.run(df, root, cfg.get("partition_by", ()))
    return spark.read.parquet(layer_path(root, "silver", cfg["name"]))


# -- run log -----------------------------------------------------------------------------------------------

# Borders of the freshness classes in hours.
FRESHNESS_CLASSES = ((1, "<1h"), (2, "1-2h"), (4, "2-4h"))
FRESHNESS_LATE = ">4h"


def run_reliability(log: DataFrame, keys: Sequence[str], failed: Column, duration: str) -> DataFrame:
    """Runs, successes, failures, success rate, average and exact P95 duration per group."""
    counts = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("runs"),
                                    F.count(F.when(failed, F.lit(1))).alias("failures"),
                                    F.avg(duration).alias("avg_duration"))
    p95 = grouped_quantile(log, keys, F.col(duration), {"p95_duration": 0.95})
    return null_safe_join(counts, p95, list(keys), "left").select(
        *keys, "runs", (F.col("runs") - F.col("failures")).alias("successes"), "failures",
        (F.lit(100.0) * (F.col("runs") - F.col("failures")) / F.col("runs")).alias("success_rate"),
        "avg_duration", "p95_duration")


def recovery_time(log: DataFrame, keys: Sequence[str], failed: Column, minutes: str) -> DataFrame:
    """Mean minutes to resolution of the failed runs per group."""
    return log.filter(failed).groupBy(*keys).agg(F.count(F.lit(1)).alias("failures"), F.avg(minutes).alias("mttr"))


def freshness_distribution(df: DataFrame, hours: Column, sla_hours: float = 4.0) -> DataFrame:
    """Rows per freshness class with their share, and whether the class meets the SLA."""
    label = reduce(lambda e, item: e.when(hours < item[0], item[1]), FRESHNESS_CLASSES[1:],
                   F.when(hours < FRESHNESS_CLASSES[0][0], FRESHNESS_CLASSES[0][1])).otherwise(FRESHNESS_LATE)
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(label.alias("freshness")).agg(
        F.count(F.lit(1)).alias("records"), F.count(F.when(hours <= sla_hours, F.lit(1))).alias("within_sla")
    ).withColumn("share_pct", F.lit(100.0) * F.col("records") / total)


def stale_fallback(df: DataFrame, date_column: str, wanted: dt.date) -> DataFrame:
    """Rows of the latest day not after the wanted one, with ``is_stale``; other days are pruned by a literal."""
    day = F.to_date(F.col(date_column))
    latest = df.filter(day <= F.lit(wanted)).agg(F.max(day).alias("d")).first()["d"]
    return df.filter(day == F.lit(latest)).withColumn("is_stale", F.lit(latest != wanted))


def landed_file_checks(spark: SparkSession, folder: str, pattern: str, required: Sequence[str],
                       rows: tuple[int, int], fmt: str = "parquet") -> DataFrame:
    """Per landed file, told apart by its path: non-empty, row count in range, required columns present.

    Parquet files are judged by their own footers, so no data is read, a column that only other files have is missing, one that is
    all NULL is there, and a broken file is a row that fails. Of other formats rows are counted, and a column is
    present in a file that fills it at least once.
    """
    def plain(path: Column) -> Column:  # one or three slashes after the scheme
        return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")

    if fmt == "parquet":
        names = F.transform("columns", lambda c: c["name"])
        present = F.coalesce(F.size(F.array_except(F.array(*[F.lit(c) for c in required]).cast("array<string>"), names)) == 0, F.lit(False))
        found = parquet_footers(spark, folder, pattern).select(
            plain(F.col("path")).alias("path"), "size_bytes", F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"), present.alias("columns_ok"))
    else:
        listed = file_listing(spark, folder, pattern).select(plain(F.col("path")).alias("path"), "size_bytes")
        data = (spark.read.format(fmt).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
                .option("header", "true").load(folder))
        known = [c for c in required if c in data.columns]
        where = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        counted = data.groupBy(plain(where).alias("path")).agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"__n_{c}") for c in known])
        filled = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"__n_{c}"), F.lit(0)) > 0 for c in known], F.lit(len(known) == len(required)))
        found = listed.join(counted, "path", "left").select("path", "size_bytes", F.coalesce("n", F.lit(0).cast("long")).alias("row_count"),
                                                            filled.alias("columns_ok"))
    n = F.col("row_count")
    return found.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "row_count", (F.col("size_bytes") > 0).alias("has_content"),
        n.between(*rows).alias("row_count_ok"), "columns_ok", ((F.col("size_bytes") > 0) & n.between(*rows) & F.col("columns_ok")).alias("accepted"))
