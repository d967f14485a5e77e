"""Exact quantiles that stay exact, and bounded in memory, at any size.

``percentile`` keeps one map of all distinct values in one task. Here the order statistics a quantile needs are closed
in on instead: one aggregate counts the values per bin between minimum and maximum, the bins that hold a wanted
position become the next, narrower ranges, and a range with few values is sorted. Three rounds separate 10^13 values;
a column of few distinct values is done after one. Nothing but bin counts is shuffled, and ranges are literals that
reach the scan. All columns and quantiles of a call share each round. Neighbours are interpolated linearly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.split_window import SplitWindow, null_safe_join

BINS = 4096
SORTED_ROWS = 100_000


def column_stats(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, dict]:
    """Rows, count, mean, sample deviation, sum, minimum and maximum per column, in one aggregate."""
    if not columns:
        return {}
    exprs = []
    for name, c in columns.items():
        exprs += [F.count(c).alias(f"{name}|n"), F.avg(c).alias(f"{name}|mean"), F.stddev_samp(c).alias(f"{name}|std"),
                  F.sum(c).alias(f"{name}|sum"), F.min(c).alias(f"{name}|min"), F.max(c).alias(f"{name}|max")]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *exprs).first().asDict()
    return {name: {"rows": row["rows"], **{k: row[f"{name}|{k}"] for k in ("n", "mean", "std", "sum", "min", "max")}}
            for name in columns}


@dataclass
class _Range:
    """Values of a column between ``lo`` and ``hi``: how many lie below and inside, and the positions wanted."""

    column: str
    lo: float
    hi: float
    below: int
    inside: int
    positions: list[int]
    stalled: int = 0


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], probs: Mapping[str, Sequence[float]],
                    stats: Mapping[str, dict] | None = None,
                    sorted_rows: int = SORTED_ROWS) -> dict[str, dict[float, float | None]]:
    """Quantiles per column; a handful of numbers on the driver, usable as pushed-down literals.

    ``stats`` needs ``n``, ``min`` and ``max`` of each column; wider limits than the true ones do no harm.
    """
    stats = stats or column_stats(df, columns)
    values = {c: col.cast("double") for c, col in columns.items()}
    found: dict[tuple[str, int], float] = {}
    pending = []
    for c in columns:
        n = stats[c]["n"]
        if n:
            at = sorted({k for p in probs[c] for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})
            pending.append(_Range(c, float(stats[c]["min"]), float(stats[c]["max"]), 0, n, at))
    while pending:
        ready = [r for r in pending if r.lo == r.hi]
        rest = [r for r in pending if r.lo != r.hi]
        for r in ready:
            found.update({(r.column, k): r.lo for k in r.positions})
        small = [r for r in rest if r.inside <= sorted_rows]
        hard = [r for r in rest if r.inside > sorted_rows and (r.stalled > 2 or not math.isfinite(r.hi - r.lo))]
        if small:
            found.update(_sort_ranges(df, values, small))
        for r in hard:
            found.update(_select_by_position(df, values[r.column], r))
        pending = _narrow(df, values, [r for r in rest if r not in small and r not in hard])
    out: dict[str, dict[float, float | None]] = {}
    for c in columns:
        n, out[c] = stats[c]["n"], {}
        for p in probs[c]:
            low = math.floor(p * (n - 1)) if n else 0
            a, b = (found[c, low], found[c, math.ceil(p * (n - 1))]) if n else (None, None)
            out[c][p] = a + (b - a) * (p * (n - 1) - low) if n else None
    return out


def _members(df: DataFrame, values: Mapping[str, Column], ranges: Sequence[_Range],
             bin_of: Callable[[_Range], Column] = lambda r: F.lit(0)) -> DataFrame:
    """One row ``(r, b, v)`` for every value inside range ``r``; other rows are filtered at the scan.

    ``stack`` stays inside code generation, where an array of structs would not.
    """
    inside = [values[r.column].between(r.lo, r.hi) for r in ranges]
    kept = df.filter(reduce(lambda a, b: a | b, inside))
    if len(ranges) == 1:
        return kept.select(F.lit(0).alias("r"), bin_of(ranges[0]).alias("b"), values[ranges[0].column].alias("v"))
    cells = []
    for i, (r, hit) in enumerate(zip(ranges, inside)):
        cells += [F.lit(i), F.when(hit, bin_of(r)), values[r.column]]
    return kept.select(F.stack(F.lit(len(ranges)), *cells).alias("r", "b", "v")).filter("b IS NOT NULL")


def _narrow(df: DataFrame, values: Mapping[str, Column], ranges: Sequence[_Range]) -> list[_Range]:
    if not ranges:
        return []

    def bin_of(r: _Range) -> Column:
        share = (values[r.column] - F.lit(r.lo)) / F.lit(r.hi - r.lo)
        return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")

    counts = _members(df, values, ranges, bin_of).groupBy("r", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    out = []
    for i, r in enumerate(ranges):
        below, wanted = r.below, list(r.positions)
        for row in sorted((x for x in counts if x["r"] == i), key=lambda x: x["b"]):
            here = [k for k in wanted if k < below + row["n"]]
            if here:
                stalled = r.stalled + 1 if row["n"] > r.inside / 2 else 0
                out.append(_Range(r.column, row["lo"], row["hi"], below, row["n"], here, stalled))
                wanted = [k for k in wanted if k not in here]
            below += row["n"]
    return out


def _sort_ranges(df: DataFrame, values: Mapping[str, Column], ranges: Sequence[_Range]) -> dict:
    """Values at the wanted positions of ranges that hold at most ``sorted_rows`` values each."""
    lists = _members(df, values, ranges).groupBy("r").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    pick = F.lit(None)
    for i, r in enumerate(ranges):
        pick = F.when(F.col("r") == i, F.array(*[F.get("vs", F.lit(k - r.below)) for k in r.positions])).otherwise(pick)
    rows = lists.select("r", pick.alias("picked")).collect()
    return {(ranges[row["r"]].column, k): v for row in rows for k, v in zip(ranges[row["r"]].positions, row["picked"])}


def _select_by_position(df: DataFrame, value: Column, r: _Range) -> dict:
    """For values that bins of equal width cannot part (extreme or infinite spread): cumulative counts."""
    counted = (df.filter(value.between(r.lo, r.hi)).select(value.alias("v")).groupBy("v")
               .agg(F.count(F.lit(1)).alias("n")))
    placed = SplitWindow(counted, [], "v").total("upto", F.col("n")).result()
    row = placed.agg(*[F.min(F.when(F.col("upto") > k - r.below, F.col("v"))).alias(f"k{k}") for k in r.positions]).first()
    return {(r.column, k): row[f"k{k}"] for k in r.positions}


def grouped_quantile(df: DataFrame, keys: Sequence[str], value: Column, probs: Mapping[str, float],
                     max_distinct: int = 0) -> DataFrame:
    """Exact quantiles per group: ``keys`` plus one column per entry of ``probs``.

    Values are counted per (group, value) first, which combines map-side; positions come from a split window, so that no
    group, however large, is gathered in one task. ``max_distinct`` is kept for callers and has no effect.
    """
    counted = (df.select(*keys, value.cast("double").alias("__v")).filter("__v IS NOT NULL")
               .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")))
    sizes = counted.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    placed = SplitWindow(counted, keys, "__v").total("__upto", F.col("__n")).result()
    rows = null_safe_join(placed, sizes, list(keys), "inner")
    picks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("__size") - 1)
        picks += [F.min(F.when(F.col("__upto") > F.floor(at), F.col("__v"))).alias(f"__a_{name}"),
                  F.min(F.when(F.col("__upto") > F.ceil(at), F.col("__v"))).alias(f"__b_{name}"),
                  F.max(at - F.floor(at)).alias(f"__f_{name}")]
    picked = rows.groupBy(*keys).agg(*picks)
    return picked.select(*keys, *[
        (F.col(f"__a_{n}") + (F.col(f"__b_{n}") - F.col(f"__a_{n}")) * F.col(f"__f_{n}")).alias(n) for n in probs])
