"""Windowed checks over series.

The daily checks first reduce a table to one row per series and day, so a window partition is never longer than
the calendar however hot the series is. Checks on raw rows use :class:`SplitWindow`.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.split_window import SplitWindow

#: Days of a complete grid that one task gets.
GRID_ROWS = 1_000_000


def daily_totals(df: DataFrame, keys: Sequence[str], ts: str, value: str, output: str = "total") -> DataFrame:
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        F.sum(value).alias(output), F.count(F.lit(1)).alias("records"))


def calendar_span(daily: DataFrame, keys: Sequence[str], start: Column | None = None, end: Column | None = None) -> tuple[Column, Column, int]:
    """First and last day of the whole table unless given, and the number of tasks that a complete grid needs.

    A grid has far more rows than the table it comes from, so tasks are counted in days of the grid, not in bytes of the table.
    """
    seen = daily.agg((F.min("day") if start is None else start).cast("date").alias("a"), (F.max("day") if end is None else end).cast("date").alias("b"),
                     F.approx_count_distinct(F.xxhash64(*keys)).alias("n")).first()
    days = (seen["b"] - seen["a"]).days + 1 if seen["a"] and seen["b"] else 0
    tasks = max(daily.sparkSession.sparkContext.defaultParallelism, -(-seen["n"] * days // GRID_ROWS))
    return F.lit(seen["a"]).cast("date"), F.lit(seen["b"]).cast("date"), tasks


def zero_filled(daily: DataFrame, keys: Sequence[str], value: str, start: Column | None = None,
                end: Column | None = None, rows: DataFrame | None = None) -> DataFrame:
    """A complete daily grid per series; days without rows get 0.

    Borders default to the first and last day of the whole table. Each row is exploded over the gap up to the
    next row of its series, so the grid needs one window and no join. A task gets about ``GRID_ROWS`` days of the grid.
    ``rows`` may be the rows that ``daily`` adds up, with ``keys`` and ``day``: the calendar is then found without adding up.
    """
    start, end, tasks = calendar_span(daily if rows is None else rows, keys, start, end)
    order = Window.partitionBy(*keys).orderBy("day")
    gaps = daily.repartition(tasks, *keys).select(*keys, value, F.col("day").alias("__at"),
                                                  F.lag("day").over(order).alias("__last"), F.lead("day").over(order).alias("__next"))
    first = F.when(F.col("__last").isNull(), start).otherwise(F.col("__at"))
    last = F.coalesce(F.date_sub(F.col("__next"), 1), end)
    grid = gaps.select(*keys, value, "__at", F.explode(F.sequence(first, last)).alias("day"))
    filled = F.when(F.col("day") == F.col("__at"), F.col(value)).otherwise(
        F.lit(0).cast(daily.schema[value].dataType))
    return grid.select(*keys, "day", filled.alias(value))


def filled_series(daily: DataFrame, keys: Sequence[str], value: str, output: str = "series", rows: DataFrame | None = None, first: str | None = None) -> DataFrame:
    """The grid of :func:`zero_filled` as one array of doubles per key, in day order.

    Days with rows are gathered and the zeros between them put in as runs, so no row is made for a day without any. Rows without a day
    add nothing to their series.
    ``rows`` is that of :func:`zero_filled`; ``first`` names a further column with the first day of the series.
    """
    start, end, tasks = calendar_span(daily if rows is None else rows, keys)
    entries = F.sort_array(F.collect_list(F.when(F.col("day").isNotNull(), F.struct("day", F.col(value).cast("double").alias("v")))))
    known = daily.repartition(tasks, *keys).groupBy(*keys).agg(entries.alias("__known"))
    zeros = lambda since, until: F.array_repeat(F.lit(0.0), F.datediff(until, since) - 1)
    runs = F.transform("__known", lambda e, i: F.concat(F.array(e["v"]), zeros(e["day"], F.coalesce(F.get("__known", i + 1)["day"], F.date_add(end, 1)))))
    return known.select(*keys, *([start.alias(first)] if first else []), F.concat(zeros(F.date_sub(start, 1), F.coalesce(F.get("__known", F.lit(0))["day"], F.date_add(end, 1))), F.flatten(runs)).alias(output))


def rolling_deviation(daily: DataFrame, keys: Sequence[str], value: str, window_size: int = 7,
                      n_std: float = 2.0) -> DataFrame:
    """Flag values outside mean ± ``n_std`` deviations of the previous ``window_size`` rows; short starts pass."""
    frame = Window.partitionBy(*keys).orderBy("day").rowsBetween(-window_size, -1)
    with_stats = daily.select(*keys, "day", value, F.avg(value).over(frame).alias("rolling_mean"),
                              F.stddev_samp(value).over(frame).alias("rolling_std"),
                              F.count(value).over(frame).alias("in_window"))
    outside = F.abs(F.col(value) - F.col("rolling_mean")) > n_std * F.col("rolling_std")
    return with_stats.withColumn("is_deviation", F.coalesce((F.col("in_window") >= window_size) & outside, F.lit(False)))


def rolling_cv(daily: DataFrame, keys: Sequence[str], value: str, window_size: int = 7) -> DataFrame:
    frame = Window.partitionBy(*keys).orderBy("day").rowsBetween(-(window_size - 1), 0)
    mean = F.avg(value).over(frame)
    return daily.select(*keys, "day", value, (F.stddev_samp(value).over(frame) / F.nullif(mean, F.lit(0.0)))
                        .alias("rolling_cv"))


def change_over(daily: DataFrame, keys: Sequence[str], value: str, days: int, threshold_pct: float) -> DataFrame:
    """Percentage change against the value ``days`` earlier on a complete daily grid."""
    before = F.lag(value, days).over(Window.partitionBy(*keys).orderBy("day"))
    out = daily.select(*keys, "day", value, before.alias("previous"))
    pct = (F.col(value) - F.col("previous")) * 100.0 / F.nullif(F.col("previous"), F.lit(0.0))
    return out.withColumn("change_pct", pct).withColumn(
        "is_volatile", F.coalesce(F.abs(F.col("change_pct")) > threshold_pct, F.lit(False)))


def weekday_zscore(daily: DataFrame, keys: Sequence[str], value: str, threshold: float = 2.0) -> DataFrame:
    """Deviation of each day from the mean of the same weekday of its series."""
    base = Window.partitionBy(*keys, "weekday")
    days = daily.withColumn("weekday", F.dayofweek("day"))
    scored = days.select(*keys, "day", "weekday", value, F.avg(value).over(base).alias("baseline"),
                         F.stddev_samp(value).over(base).alias("spread"))
    z = (F.col(value) - F.col("baseline")) / F.nullif(F.col("spread"), F.lit(0.0))
    return scored.withColumn("zscore", z).withColumn("is_seasonal_outlier",
                                                     F.coalesce(F.abs(F.col("zscore")) > threshold, F.lit(False)))


def trend_break(daily: DataFrame, keys: Sequence[str], value: str, n: int, threshold_pct: float) -> DataFrame:
    """Mean of the last ``n`` rows against the ``n`` rows before them."""
    order = Window.partitionBy(*keys).orderBy("day")
    recent, earlier = order.rowsBetween(-(n - 1), 0), order.rowsBetween(-(2 * n - 1), -n)
    out = daily.select(*keys, "day", value, F.avg(value).over(recent).alias("recent_mean"),
                       F.avg(value).over(earlier).alias("earlier_mean"),
                       F.count(value).over(earlier).alias("__n"))
    pct = (F.col("recent_mean") - F.col("earlier_mean")) * 100.0 / F.nullif(F.col("earlier_mean"), F.lit(0.0))
    full = F.col("__n") == n
    return out.select(*keys, "day", value, F.when(full, pct).alias("trend_pct"),
                      F.coalesce(full & (F.abs(pct) > threshold_pct), F.lit(False)).alias("is_break"))


def consecutive_runs(df: DataFrame, keys: Sequence[str], order: str, hit: Column, tiebreak: Sequence[str] = (),
                     at_least: int = 3) -> DataFrame:
    """Runs of at least ``at_least`` consecutive hits per key.

    Hits between two misses share the running number of misses, which makes the run a plain group.
    """
    numbered = SplitWindow(df, keys, order, tiebreak).total("__misses", F.when(hit, 0).otherwise(1)).result()
    runs = numbered.filter(hit).groupBy(*keys, "__misses").agg(
        F.count(F.lit(1)).alias("run_length"), F.min(order).alias("run_start"), F.max(order).alias("run_end"))
    return runs.filter(F.col("run_length") >= at_least).drop("__misses")


def ranked(df: DataFrame, keys: Sequence[str], value: str, output: str = "position") -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY value DESC)`` without one task per key."""
    return SplitWindow(df, keys, -F.col(value)).rank(output).result()


def cumulative_share(df: DataFrame, value: str, tiebreak: Sequence[str], output: str = "share") -> DataFrame:
    """Share of the grand total reached by each row, largest value first, without a single-partition window."""
    placed = SplitWindow(df, [], -F.col(value), tiebreak).total("__upto", F.col(value)).result()
    total = df.agg(F.sum(value).alias("t")).scalar()
    return placed.withColumn(output, F.col("__upto") / F.nullif(total, F.lit(0.0))).drop("__upto")
