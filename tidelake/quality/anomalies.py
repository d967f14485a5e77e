"""Three-tier anomaly scan: validation checks, outlier statistics, volatility against history.

Checks are collected first. One aggregate gives the basic statistics of every numeric column, exact quantiles are
batched over all columns that need them, the bounds become literals, and one more aggregate counts everything, the
checks of all tiers included. Findings are a DataFrame with one row per anomaly.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Mapping, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.distributions import bound, student_quantile
from tidelake.operators.quantiles import column_stats, exact_quantiles
from tidelake.operators.series import daily_totals, rolling_deviation
from tidelake.operators.split_window import SplitWindow
from tidelake.session import materialise

# Default thresholds, severities and penalty weights.
IQR_MULTIPLIER = 1.5
ZSCORE_THRESHOLD = 3.0
MAD_THRESHOLD = 3.5
MAD_SCALE = 0.6745
PERCENTILE_BOUNDS = (0.01, 0.99)
SPIKE_PCT = 200.0
DROP_PCT = 50.0
NULL_SHARE = {"critical": 0.1, "high": 0.01}
PENALTY = {"low": 1, "medium": 5, "high": 15, "critical": 50}
MIN_SAMPLES = 30
SAMPLES = 10

FINDING_SCHEMA = ("anomaly_id string, tier int, anomaly_type string, severity string, column_name string, "
                  "affected_records bigint, value double, lower_bound double, upper_bound double, "
                  "deviation_score double")
DETAIL_SCHEMA = FINDING_SCHEMA + (", description string, detected_at timestamp_ntz, details map<string,double>, "
                                  "sample_values array<string>, sample_records array<string>")


@dataclass
class OutlierCheck:
    column: str
    method: str
    low: float = 0.0
    high: float = 0.0
    severity: str = "medium"


@dataclass
class AnomalyScan:
    """Checks for one table; several checks per column are allowed."""

    table: str = "data"
    required: list[str] = field(default_factory=list)
    positive: list[str] = field(default_factory=list)
    dates: list[tuple[str, dt.date]] = field(default_factory=list)
    rules: list[tuple[str, Column | str]] = field(default_factory=list)
    outliers: list[OutlierCheck] = field(default_factory=list)
    shifts: list[tuple[str, str, float, str]] = field(default_factory=list)
    volumes: list[tuple[int, int, str]] = field(default_factory=list)
    rolling: list[tuple[str, str, int, float, str]] = field(default_factory=list)
    min_samples: int = 0

    # -- building ------------------------------------------------------------------------------------------

    def require(self, *columns: str) -> "AnomalyScan":
        self.required += columns
        return self

    def non_negative(self, *columns: str) -> "AnomalyScan":
        self.positive += columns
        return self

    def not_after(self, column: str, as_of: dt.date) -> "AnomalyScan":
        self.dates.append((column, as_of))
        return self

    def rule(self, name: str, valid: Column | str) -> "AnomalyScan":
        self.rules.append((name, valid))
        return self

    def iqr(self, column: str, multiplier: float = IQR_MULTIPLIER, severity: str = "medium") -> "AnomalyScan":
        self.outliers.append(OutlierCheck(column, "iqr", multiplier, multiplier, severity))
        return self

    def zscore(self, column: str, threshold: float = ZSCORE_THRESHOLD, severity: str = "medium") -> "AnomalyScan":
        self.outliers.append(OutlierCheck(column, "zscore", threshold, threshold, severity))
        return self

    def mad(self, column: str, threshold: float = MAD_THRESHOLD, severity: str = "medium") -> "AnomalyScan":
        self.outliers.append(OutlierCheck(column, "mad", threshold, threshold, severity))
        return self

    def percentile(self, column: str, low: float = PERCENTILE_BOUNDS[0], high: float = PERCENTILE_BOUNDS[1],
                   severity: str = "low") -> "AnomalyScan":
        self.outliers.append(OutlierCheck(column, "percentile", low, high, severity))
        return self

    def spike(self, column: str, threshold_pct: float = SPIKE_PCT, severity: str = "high") -> "AnomalyScan":
        self.shifts.append(("spike", column, threshold_pct, severity))
        return self

    def drop(self, column: str, threshold_pct: float = DROP_PCT, severity: str = "high") -> "AnomalyScan":
        self.shifts.append(("drop", column, threshold_pct, severity))
        return self

    def volume(self, expected_min: int, expected_max: int, severity: str = "high") -> "AnomalyScan":
        self.volumes.append((expected_min, expected_max, severity))
        return self

    def rolling_average(self, column: str, date_column: str, window_size: int = 7, n_std: float = 2.0,
                        severity: str = "medium") -> "AnomalyScan":
        self.rolling.append((column, date_column, window_size, n_std, severity))
        return self

    # -- running -------------------------------------------------------------------------------------------

    def findings(self, df: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """One row per anomaly over all three tiers; every count comes from one aggregate over ``df``."""
        one, rows, rolling = self._evaluate(df, history)
        parts = [_explode(one, rows)] if rows else []
        parts += [_explode(frame, [finding]) for frame, finding in rolling]
        if not parts:
            return df.sparkSession.createDataFrame([], FINDING_SCHEMA)
        return reduce(DataFrame.unionByName, parts).drop("pos")

    def detailed(self, df: DataFrame, history: DataFrame | None = None, detected_at: dt.datetime | None = None,
                 samples: int = SAMPLES) -> DataFrame:
        """Findings with a description, the time, what a bound was made of (q1, q3, iqr, mean ...), and the ``samples`` most
        extreme offending values and rows (as JSON).

        One more scan serves the samples of all checks: violations are stacked as (check, row), and each task keeps the
        first ones of a check before anything is shuffled.
        """
        one, rows, rolling = self._evaluate(df, history)
        parts = []
        if rows:
            parts.append(_explode(one, rows, True).join(_samples(df, rows, samples), "pos", "left"))
        for frame, finding in rolling:
            none = F.lit(None).cast("array<string>")
            parts.append(_explode(frame, [finding], True).withColumns({"sample_values": none, "sample_records": none}))
        if not parts:
            return df.sparkSession.createDataFrame([], DETAIL_SCHEMA)
        empty, at = F.array().cast("array<string>"), detected_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        out = reduce(DataFrame.unionByName, parts).withColumns({
            "detected_at": F.lit(str(at)).cast("timestamp_ntz"), **{c: F.coalesce(c, empty) for c in ("sample_values", "sample_records")}})
        return out.select(*[f.rsplit(" ", 1)[0].strip() for f in DETAIL_SCHEMA.split(", ")])

    def _evaluate(self, df: DataFrame, history: DataFrame | None) -> tuple[DataFrame | None, list[_Finding], list[tuple[DataFrame, _Finding]]]:
        """The aggregated row with the findings that are read from it, and a row for each rolling check; ids are distinct."""
        exprs: dict[str, Column] = {"n": F.count(F.lit(1))}
        rows = [*self._tier_one(df, exprs), *self._tier_two(df, exprs), *self._tier_three(df, history, exprs)]
        rolling = [self._rolling(df, *r) for r in self.rolling]
        taken: dict[str, int] = {}
        for finding in [f for f in [*rows, *[f for _, f in rolling]] if f.column != "_record_count"]:
            # Checks that repeat on a column are told apart by a number; ranges of the record count keep their fixed ids.
            taken[finding.anomaly_id] = count = taken.get(finding.anomaly_id, 0) + 1
            finding.anomaly_id += f"_{count}" if count > 1 else ""
        one = None
        if rows:
            one = df.agg(*[e.alias(name) for name, e in exprs.items()])
            past = self._history_columns(df, history)
            if past:  # one struct-valued scalar: history is read once, and never joined
                sums = history.agg(F.struct(*[F.sum(c).alias(c) for c in past]).alias("h"))
                one = one.withColumn("h", sums.scalar())
        return one, rows, rolling

    def grouped_outliers(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows outside a z-score check within their group of ``keys``; groups below ``min_samples`` values flag nothing.

        Statistics are one row per group. As in SQL, a NULL key is in no group.
        """
        if not self.outliers or any(c.method != "zscore" for c in self.outliers):
            raise ValueError("grouped outliers need z-score checks, and no others")
        exprs, enough, outside = [], [], []
        for i, c in enumerate(self.outliers):
            n, mean, std = (F.col(f"__{k}_{i}") for k in ("n", "mean", "std"))
            exprs += [F.count(c.column).alias(f"__n_{i}"), F.avg(c.column).alias(f"__mean_{i}"),
                      F.stddev_samp(c.column).alias(f"__std_{i}")]
            enough.append(n >= self.min_samples)
            outside.append((n >= self.min_samples) & (F.abs(F.col(c.column) - mean) > c.low * std))
        usable = df.groupBy(*keys).agg(*exprs).filter(reduce(lambda a, b: a | b, enough))
        return df.join(usable, list(keys)).filter(reduce(lambda a, b: a | b, outside)).select(*df.columns)

    def _history_columns(self, df: DataFrame, history: DataFrame | None) -> list[str]:
        if history is None:
            return []
        return sorted({c for _, c, _, _ in self.shifts if c in df.columns and c in history.columns})

    def _tier_one(self, df: DataFrame, exprs: dict[str, Column]) -> list[_Finding]:
        rows = []
        # The ids here and below are fixed values that others look findings up by.

        def counted(mask: Column) -> Column:
            name = f"c{len(exprs)}"
            exprs[name] = F.count_if(mask)
            return F.col(name)

        for c in self.required:
            if c not in df.columns:
                rows.append(_Finding(f"validation_{c}_missing", 1, "validation", F.lit("critical"), c, F.col("n"),
                                     always=True, text=F.lit(f"required column '{c}' is absent")))
                continue
            count = counted(F.col(c).isNull())
            share = F.coalesce(F.try_divide(count, F.col("n")), F.lit(0.0))
            severity = (F.when(share > NULL_SHARE["critical"], "critical").when(share > NULL_SHARE["high"], "high")
                        .otherwise("medium"))
            rows.append(_Finding(f"validation_{c}_nulls", 1, "validation", severity, c, count, value=count, mask=F.col(c).isNull(),
                                 text=F.format_string(f"'{_plain(c)}' is NULL in %d rows (%.2f%%)", count, share * 100)))
        for c in [p for p in self.positive if p in df.columns]:
            count = counted(F.col(c) < 0)
            exprs[f"low_{c}"] = F.min(c)
            rows.append(_Finding(f"validation_{c}_negative", 1, "validation", F.lit("high"), c, count,
                                 value=F.col(f"low_{c}"), mask=F.col(c) < 0, shown=F.col(c), extreme=-F.col(c).cast("double"),
                                 text=F.format_string(f"'{_plain(c)}' is negative in %d rows", count)))
        for c, as_of in [d for d in self.dates if d[0] in df.columns]:
            late = F.to_date(c) > F.lit(as_of)
            count = counted(late)
            rows.append(_Finding(f"validation_{c}_future", 1, "validation", F.lit("medium"), c, count, mask=late, shown=F.col(c),
                                 extreme=F.unix_date(F.to_date(c)).cast("double"),
                                 text=F.format_string(f"'{_plain(c)}' lies after {as_of} in %d rows", count)))
        for name, valid in self.rules:
            broken = ~(F.expr(valid) if isinstance(valid, str) else valid)
            count = counted(broken)
            rows.append(_Finding(f"validation_{name}", 1, "validation", F.lit("medium"), name, count, mask=broken,
                                 text=F.format_string(f"rule '{_plain(name)}' is broken by %d rows", count)))
        return rows

    def _tier_two(self, df: DataFrame, exprs: dict[str, Column]) -> list[_Finding]:
        checks = [c for c in self.outliers if c.column in df.columns]
        if not checks:
            return []
        rows = []
        for i, (check, limits) in enumerate(zip(checks, outlier_bounds(df, checks, self.min_samples))):
            if limits is None:
                continue
            low, high, centre, spread, details = limits
            x = F.col(check.column)
            outside = (x < low) | (x > high)
            exprs[f"outside_{i}"] = F.count_if(outside)
            score = None
            if spread:
                exprs[f"score_{i}"] = F.max(F.when(outside, F.abs(x - centre) / spread))
                score = F.col(f"score_{i}")
            rows.append(_Finding(f"outlier_{check.method}_{check.column}", 2, "outlier", F.lit(check.severity),
                                 check.column, F.col(f"outside_{i}"), low=low, high=high, score=score, mask=outside, shown=x,
                                 extreme=F.greatest(low - x, x - high).cast("double"), details=details,
                                 text=F.format_string(f"'{_plain(check.column)}' lies outside [%.2f, %.2f] in %d rows ({check.method})",
                                                      F.lit(low).cast("double"), F.lit(high).cast("double"), F.col(f"outside_{i}"))))
        return rows

    def _tier_three(self, df: DataFrame, history: DataFrame | None, exprs: dict[str, Column]) -> list[_Finding]:
        rows, n = [], F.col("n")
        past = self._history_columns(df, history)
        for c in past:
            exprs[f"now_{c}"] = F.sum(c)
        for kind, c, threshold, severity in [s for s in self.shifts if s[1] in past]:
            now, was = F.col(f"now_{c}"), F.nullif(F.col(f"h.{c}"), F.lit(0.0))
            change = (now - was) / was * 100.0
            hit = change > threshold if kind == "spike" else -change > 100.0 - threshold
            score = change if kind == "spike" else -change
            rows.append(_Finding(f"volatility_{kind}_{c}", 3, "volatility", F.lit(severity), c, n, value=now,
                                 score=score, when=hit, details={"threshold_pct": threshold},
                                 text=F.format_string(f"'{_plain(c)}' changed by %.1f%% against history ({kind})", change)))
        for low, high, severity in self.volumes:
            text = F.format_string(f"%d rows, expected {low} to {high}", n)
            rows.append(_Finding("volatility_volume_low", 3, "missing", F.lit(severity), "_record_count", low - n,
                                 value=n, low=low, high=high, when=n < low, text=text))
            rows.append(_Finding("volatility_volume_high", 3, "volatility", F.lit(severity), "_record_count", n - high,
                                 value=n, low=low, high=high, when=n > high, text=text))
        return rows

    @staticmethod
    def _rolling(df: DataFrame, column: str, date_column: str, window_size: int, n_std: float,
                 severity: str) -> tuple[DataFrame, _Finding]:
        daily = daily_totals(df, [], date_column, column).withColumn("series", F.lit(column))
        flagged = rolling_deviation(daily, ["series"], "total", window_size, n_std)
        one = flagged.agg(F.count(F.when(F.col("is_deviation"), F.lit(1))).alias("c"),
                          F.max(F.when(F.col("is_deviation"), F.abs(F.col("total") - F.col("rolling_mean")) /
                                       F.nullif(F.col("rolling_std"), F.lit(0.0)))).alias("s"))
        return one, _Finding(f"volatility_rolling_{column}", 3, "volatility", F.lit(severity), column, F.col("c"), score=F.col("s"),
                             text=F.format_string(f"daily '{_plain(column)}' left its {window_size}-day band on %d days", F.col("c")),
                             details={"window": window_size, "deviations": n_std})


def _plain(text: str) -> str:
    """Text inside a format."""
    return text.replace("%", "%%")


class Bound(NamedTuple):
    """What a check accepts, the centre and unit of its score, and what they were made of."""

    low: float
    high: float
    centre: float | None
    spread: float | None
    details: dict[str, float]


def outlier_bounds(df: DataFrame, checks: Sequence[OutlierCheck],
                   min_samples: int = 0) -> list[Bound | None]:
    """The bound of each check, None where it does not apply; at most four jobs for any number."""
    columns = {c.column: F.col(c.column) for c in checks}
    stats = column_stats(df, columns)
    wanted: dict[str, set[float]] = {}
    for check in checks:
        probs = {"iqr": (0.25, 0.75), "mad": (0.5,), "percentile": (check.low, check.high)}.get(check.method, ())
        wanted.setdefault(check.column, set()).update(probs)
    need = {c: sorted(p) for c, p in wanted.items() if p}
    quantiles = exact_quantiles(df, {c: columns[c] for c in need}, need, stats) if need else {}
    centres = {c.column: quantiles[c.column][0.5] for c in checks
               if c.method == "mad" and quantiles[c.column][0.5] is not None}
    spreads = {}
    if centres:
        spreads = exact_quantiles(df, *_distances(columns, centres, stats))
    out: list[Bound | None] = []
    for check in checks:
        s, q = stats[check.column], quantiles.get(check.column, {})
        limits = None
        if s["n"] and s["n"] >= min_samples:
            if check.method == "iqr":
                iqr = q[0.75] - q[0.25]
                limits = Bound(q[0.25] - check.low * iqr, q[0.75] + check.low * iqr, None, None, {"q1": q[0.25], "q3": q[0.75], "iqr": iqr})
            elif check.method == "zscore" and s["std"]:
                reach = check.low * s["std"]
                limits = Bound(s["mean"] - reach, s["mean"] + reach, s["mean"], s["std"], {"mean": s["mean"], "std": s["std"]})
            elif check.method == "mad" and spreads[check.column][0.5]:
                mad, centre = spreads[check.column][0.5], centres[check.column]
                unit = mad / MAD_SCALE
                limits = Bound(centre - check.low * unit, centre + check.low * unit, centre, unit, {"median": centre, "mad": mad})
            elif check.method == "percentile":
                limits = Bound(q[check.low], q[check.high], None, None, {"lower": check.low, "upper": check.high})
        out.append(limits)
    return out


def _distances(columns: Mapping[str, Column], centres: Mapping[str, float], stats: Mapping[str, dict]) -> tuple:
    """|x - centre| per column, the median wanted of each, and limits known without another pass."""
    away = {c: F.abs(columns[c] - F.lit(m)) for c, m in centres.items()}
    limits = {c: {"n": stats[c]["n"], "min": 0.0,
                  "max": max(abs(stats[c]["min"] - m), abs(stats[c]["max"] - m))} for c, m in centres.items()}
    return away, {c: [0.5] for c in away}, limits


def flag_rows(df: DataFrame, check: OutlierCheck, min_samples: int = 0) -> DataFrame:
    """Rows outside the bounds of one check; the bounds are literals that reach the scan."""
    limits = outlier_bounds(df, [check], min_samples)[0]
    if limits is None:
        return df.filter(F.lit(False))
    return df.filter((F.col(check.column) < limits[0]) | (F.col(check.column) > limits[1]))


@dataclass
class _Finding:
    """A check's outcome: fixed texts and bounds, and the columns of the aggregated row it is read from."""

    anomaly_id: str
    tier: int
    kind: str
    severity: Column
    column: str
    affected: Column
    value: Column | None = None
    low: float | None = None
    high: float | None = None
    score: Column | None = None
    when: Column | None = None
    always: bool = False
    text: Column | None = None
    details: Mapping[str, float] = field(default_factory=dict)
    mask: Column | None = None
    shown: Column | None = None
    extreme: Column | None = None


def _samples(df: DataFrame, found: Sequence[_Finding], size: int) -> DataFrame:
    """``pos, sample_values, sample_records``: the most extreme rows of each check, ties by value and then by a hash of the row."""
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [F.when(f.mask, F.struct(F.lit(pos).alias("pos"), (no_number if f.extreme is None else f.extreme).alias("extreme"),
                                     (no_text if f.shown is None else f.shown.cast("string")).alias("shown")))
             for pos, f in enumerate(found) if f.mask is not None]
    if not cells:
        return df.sparkSession.createDataFrame([], "pos int, sample_values array<string>, sample_records array<string>")
    broken = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), F.inline(F.array_compact(F.array(*cells))))
    order = Window.partitionBy("pos").orderBy(F.desc("extreme"), "shown", F.xxhash64("row"))
    first = broken.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= size)
    kept = first.groupBy("pos").agg(F.sort_array(F.collect_list(F.struct("nth", "shown", F.to_json("row").alias("record")))).alias("s"))
    return kept.select("pos", F.filter(F.transform("s", lambda x: x["shown"]), F.isnotnull).alias("sample_values"),
                       F.transform("s", lambda x: x["record"]).alias("sample_records"))


def _explode(one: DataFrame, found: Sequence[_Finding], detail: bool = False) -> DataFrame:
    """One row per check that hit; what is fixed comes from literal arrays indexed by position."""
    none = F.lit(None).cast("double")
    cells = []
    for f in found:
        hit = F.lit(True) if f.always else (f.when if f.when is not None else f.affected > 0)
        cells.append(F.struct(hit.alias("hit"), f.affected.cast("long").alias("affected"), f.severity.alias("severity"),
                              (none if f.value is None else f.value.cast("double")).alias("value"),
                              (none if f.score is None else f.score.cast("double")).alias("score"),
                              *([f.text.alias("description")] if detail else [])))
    rows = one.select(F.posexplode(F.array(*cells)).alias("pos", "c")).filter("c.hit")

    def fixed(values: Sequence[Any], dtype: str) -> Column:
        return F.get(F.from_json(F.lit(json.dumps(list(values))), f"array<{dtype}>"), F.col("pos"))

    return rows.select(
        fixed([f.anomaly_id for f in found], "string").alias("anomaly_id"), fixed([f.tier for f in found], "int").alias("tier"),
        fixed([f.kind for f in found], "string").alias("anomaly_type"), F.col("c.severity").alias("severity"),
        fixed([f.column for f in found], "string").alias("column_name"), F.col("c.affected").alias("affected_records"),
        F.col("c.value").alias("value"), fixed([f.low for f in found], "double").alias("lower_bound"),
        fixed([f.high for f in found], "double").alias("upper_bound"), F.col("c.score").alias("deviation_score"), "pos",
        *([F.col("c.description").alias("description"), fixed([f.details for f in found], "map<string,double>").alias("details")] if detail else []))


# -- reports -----------------------------------------------------------------------------------------------

def report(findings: DataFrame) -> DataFrame:
    """Anomaly counts by type and severity."""
    return findings.groupBy("anomaly_type", "severity").agg(F.count(F.lit(1)).alias("anomalies"),
                                                            F.sum("affected_records").alias("affected_records"))


def health_score(findings: DataFrame) -> DataFrame:
    """100 minus a penalty per finding, not below 0."""
    weights = F.create_map(*[F.lit(x) for item in PENALTY.items() for x in item])
    penalty = F.coalesce(F.sum(weights[F.col("severity")]), F.lit(0).cast("long"))
    return findings.agg(F.count(F.lit(1)).alias("total_anomalies"),
                        F.greatest(F.lit(0).cast("long"), 100 - penalty).alias("health_score"))


def quick_scan(df: DataFrame, required: Sequence[str] = (), numeric: Sequence[str] = (),
               history: DataFrame | None = None) -> DataFrame:
    scan = AnomalyScan().require(*required)
    for c in numeric:
        scan.iqr(c)
    return scan.findings(df, history)


def alert_severity(metrics: DataFrame) -> DataFrame:
    """Alert level per metric row (columns ``metric``, ``measure``); rows without an alert are dropped.

    Metrics: ``invalid_pct``, ``anomaly_count``, ``volume_change_pct``, ``quality_score_pct``, ``stale_hours``,
    ``duration_ratio``.
    """
    m, v = F.col("metric"), F.col("measure")
    # Alert limits.
    level = (F.when((m == "invalid_pct") & (v > 5), "high")
             .when((m == "anomaly_count") & (v > 50), "medium")
             .when((m == "volume_change_pct") & (F.abs(v) > 50), "high")
             .when((m == "quality_score_pct") & (v < 95), "medium")
             .when((m == "stale_hours") & (v > 4), "high")
             .when((m == "duration_ratio") & (v > 2), "medium"))
    return metrics.withColumn("alert", level).filter("alert IS NOT NULL")


# -- distribution and range checks against history ---------------------------------------------------------

def drift_psi(current: DataFrame, reference: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Population stability index over reference-quantile bins: one row per bin with its contribution.

    Empty bins count as half a row, so the index stays finite.
    """
    probs = [i / bins for i in range(1, bins)]
    edges = sorted(set(exact_quantiles(reference, {column: F.col(column)}, {column: probs})[column].values()))
    edges = [e for e in edges if e is not None]
    bucket = F.lit(0)
    for e in edges:  # the number of edges below the value
        bucket = bucket + (F.col(column) > F.lit(e)).cast("int")

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col(column).isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias(name))

    every = current.sparkSession.range(len(edges) + 1).select(F.col("id").cast("int").alias("bin"))
    both = every.join(counts(reference, "expected"), "bin", "left").join(counts(current, "actual"), "bin", "left")
    totals = both.agg(F.struct(F.sum("expected").alias("e"), F.sum("actual").alias("a")).alias("t")).scalar()
    zero = F.lit(0).cast("long")
    full = both.select("bin", F.coalesce("expected", zero).alias("expected"), F.coalesce("actual", zero).alias("actual"))
    p = F.greatest(F.col("expected"), F.lit(0.5)) / totals["e"]
    q = F.greatest(F.col("actual"), F.lit(0.5)) / totals["a"]
    return full.withColumn("psi", (q - p) * F.ln(q / p))


def historical_range(current: DataFrame, history: DataFrame, key: str, column: str) -> DataFrame:
    """Current rows outside the range their key showed before; keys without history pass."""
    seen = history.groupBy(key).agg(F.min(column).alias("seen_min"), F.max(column).alias("seen_max"))
    return current.join(seen, key).filter((F.col(column) < F.col("seen_min")) | (F.col(column) > F.col("seen_max")))


def velocity_check(current: DataFrame, history: DataFrame, key: str, ts: str, value: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Current readings whose change per hour since the key's previous reading lies outside the range of its past rates.

    The previous reading may lie in ``history``: both tables form one stream per key, ordered through a split window, so a
    key with very many readings is spread over tasks. Readings without a predecessor or at its very moment have no
    rate; keys without a past rate pass.
    """
    columns = list(dict.fromkeys([key, ts, value, *tiebreak]))
    stream = history.select(*columns, F.lit(0).alias("__now")).unionByName(current.select(*columns, F.lit(1).alias("__now")))
    stream = stream.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    seen = SplitWindow(stream, [key], ts, ["__now", *tiebreak]).previous("__before", F.struct(F.col(ts).alias("at"), F.col(value).alias("was"))).result()
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    hours = (micros(F.col(ts)) - micros(F.col("__before.at"))) / 3.6e9
    rates = seen.withColumn("rate", (F.col(value) - F.col("__before.was")) / F.nullif(hours, F.lit(0.0))).filter("rate IS NOT NULL")
    rates = materialise(rates.drop("__before"), "rates")
    past = rates.filter("__now = 0").groupBy(key).agg(F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"))
    return rates.filter("__now = 1").drop("__now").join(past, key).filter((F.col("rate") < F.col("min_rate")) | (F.col("rate") > F.col("max_rate")))


def context_season(daily: DataFrame, keys: Sequence[str], value: str, events: Sequence[dt.date] = (), threshold: float = MAD_THRESHOLD,
                   rounds: int = 3) -> DataFrame:
    """Days beyond ``threshold`` modified z-scores of what weekday and week of the year lead to expect.

    Median polish: medians of the weekdays, then of the weeks, are taken out of what is left, ``rounds`` times; the median absolute
    residual of a series is its spread. ``events`` (holidays, campaigns) shape neither medians nor spread, but are
    judged. One row per series and day in, so a window never holds more than the days of one series.
    """
    day = F.col("day")
    usual = ~day.isin(list(events)) if events else F.lit(True)
    rest = daily.select(*keys, "day", value, F.dayofweek(day).alias("__weekday"), F.weekofyear(day).alias("__week"), usual.alias("__usual"),
                        F.col(value).cast("double").alias("residual"))

    def median(column: str, *groups: str) -> Column:
        return F.coalesce(F.median(F.when(F.col("__usual"), F.col(column))).over(Window.partitionBy(*keys, *groups)), F.lit(0.0))

    for _ in range(rounds):
        for group in ("__weekday", "__week"):
            rest = rest.withColumn("residual", F.col("residual") - median("residual", group))
    spread = rest.withColumn("residual", F.col("residual") - median("residual")).withColumn("__size", F.abs("residual")).withColumn(
        "spread", median("__size") / MAD_SCALE)
    score = F.col("residual") / F.nullif(F.col("spread"), F.lit(0.0))
    out = spread.select(*keys, "day", value, (F.col(value) - F.col("residual")).alias("expected"), score.alias("score"), (~F.col("__usual")).alias("is_event"))
    return out.filter(F.abs("score") > threshold)


def context_threshold(df: DataFrame, day: str, column: str, calendar: Mapping[str, float] | None = None,
                      base: float = 2.0, weekend: float = 3.0) -> DataFrame:
    """Flag values beyond a day-dependent number of deviations of their weekday.

    ``calendar`` maps ISO dates (holidays, campaigns) to their own threshold. Weekday statistics are seven rows.
    """
    days = df.withColumn("weekday", F.dayofweek(day))
    stats = days.groupBy("weekday").agg(F.avg(column).alias("baseline"), F.stddev_samp(column).alias("spread"))
    limit = F.when(F.col("weekday").isin(1, 7), weekend).otherwise(base)
    if calendar:
        special = F.create_map(*[x for d, t in calendar.items() for x in (F.lit(d), F.lit(float(t)))])
        limit = F.coalesce(F.try_element_at(special, F.date_format(F.to_date(day), "yyyy-MM-dd")), limit)
    scored = days.join(F.broadcast(stats), "weekday").withColumn("threshold", limit)  # at most seven rows
    z = F.abs(F.col(column) - F.col("baseline")) / F.nullif(F.col("spread"), F.lit(0.0))
    return scored.filter(z > F.col("threshold"))


def grubbs_critical(n: Column, level: float = 0.05) -> Column:
    """Two-sided critical value of Grubbs' test for groups of ``n`` values, from the quantile of Student's t; NULL below three."""
    size = n.cast("double")
    value = bound(student_quantile(n - 2, F.lit(level) / n), lambda t: (size - 1) / F.sqrt(size) * F.sqrt(t * t / (size - 2 + t * t)))
    return F.when(n >= 3, value)


def grubbs(df: DataFrame, keys: Sequence[str], column: str, critical: bool = False) -> DataFrame:
    """Grubbs statistic ``G = max |x - mean| / s`` per group, optionally with its critical value and verdict.

    The largest distance is reached at the minimum or maximum, so one map-side combined aggregate is enough; the
    critical value is worked out on the one row per group that is left.
    """
    stats = df.groupBy(*keys).agg(F.count(column).alias("n"), F.avg(column).alias("mean"),
                                  F.stddev_samp(column).alias("std"), F.min(column).alias("lowest"),
                                  F.max(column).alias("highest"))
    far = F.greatest(F.col("highest") - F.col("mean"), F.col("mean") - F.col("lowest"))
    out = stats.withColumn("g", far / F.nullif(F.col("std"), F.lit(0.0)))
    if not critical:
        return out
    return out.withColumn("critical", grubbs_critical(F.col("n"))).withColumn(
        "is_outlier", F.coalesce(F.col("g") > F.col("critical"), F.lit(False)))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum, sum and MAD per column, as rows."""
    cols = {c: F.col(c) for c in columns}
    stats = column_stats(df, cols)
    q = exact_quantiles(df, cols, {c: [0.25, 0.5, 0.75] for c in columns}, stats)
    medians = {c: q[c][0.5] for c in columns if q[c][0.5] is not None}
    mads = exact_quantiles(df, *_distances(cols, medians, stats)) if medians else {}
    rows = []
    for c in columns:
        s = stats[c]
        numbers = [s["mean"], s["std"], s["min"], q[c][0.25], q[c][0.5], q[c][0.75], s["max"], s["sum"],
                   mads.get(c, {}).get(0.5)]
        rows.append((c, s["n"], *[None if x is None else float(x) for x in numbers]))
    return df.sparkSession.createDataFrame(rows, "column_name string, n bigint, mean double, std double, min double, "
                                                 "q1 double, median double, q3 double, max double, total double, "
                                                 "mad double")
