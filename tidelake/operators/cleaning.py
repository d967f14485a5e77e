"""Projection, null handling, deduplication and outlier removal: plain ``DataFrame -> DataFrame`` functions."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions import text, values
from tidelake.operators import ledger
from tidelake.operators.quantiles import column_stats, exact_quantiles
from tidelake.operators.split_window import SplitWindow


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


# -- projections -------------------------------------------------------------------------------------------

def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def reorder_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    first = _present(df, columns)
    return df.select(*first, *[c for c in df.columns if c not in first])


def add_column(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def filter_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.filter(condition)


def coalesce_columns(df: DataFrame, output: str, sources: Sequence[str]) -> DataFrame:
    found = _present(df, sources)
    return df.withColumn(output, F.coalesce(*found)) if found else df


def on_columns(df: DataFrame, columns: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: fn(F.col(c)) for c in _present(df, columns)})


# -- nulls -------------------------------------------------------------------------------------------------

def fill_nulls(df: DataFrame, rules: Mapping[str, Any], keys: Sequence[str] = (),
               order: str | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Fill NULLs per column: a constant, a function of the column, or a named strategy.

    Strategies are ``mean``, ``median``, ``mode``, ``zero``, ``forward``, ``backward`` and ``interpolate``. The
    last three need ``order``; ``keys`` limits them to a series. All statistics of one call come from shared
    aggregates and enter the plan as literals.
    """
    rules = {c: r for c, r in rules.items() if c in df.columns}
    named = {c: r for c, r in rules.items()
             if isinstance(r, str) and r in ("mean", "median", "mode", "forward", "backward", "interpolate")}
    fills: dict[str, Column] = {}
    stats = column_stats(df, {c: F.col(c) for c, r in named.items() if r in ("mean", "median")})
    medians = [c for c, r in named.items() if r == "median"]
    if medians:
        found = exact_quantiles(df, {c: F.col(c) for c in medians}, {c: [0.5] for c in medians}, stats)
    for c, rule in rules.items():
        if c not in named:
            value = rule(F.col(c)) if callable(rule) else F.coalesce(
                F.col(c), F.lit(0 if isinstance(rule, str) and rule == "zero" else rule))
            fills[c] = value
        elif rule == "mean":
            fills[c] = F.coalesce(F.col(c), F.lit(stats[c]["mean"]))
        elif rule == "median":
            fills[c] = F.coalesce(F.col(c), F.lit(found[c][0.5]))
        elif rule == "mode":
            fills[c] = F.coalesce(F.col(c), F.lit(most_frequent(df, c)))
    out = df.withColumns(fills) if fills else df
    ordered = {c: r for c, r in named.items() if r in ("forward", "backward", "interpolate")}
    if ordered:
        if order is None:
            raise ValueError("forward, backward and interpolate need an order column")
        out = _fill_ordered(out, ordered, keys, order, tiebreak)
    return out.select(*df.columns)


def most_frequent(df: DataFrame, column: str) -> Any:
    """Most frequent non-null value, lowest value on ties; the counts never leave the executors."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.min_by(column, F.struct((-F.col("n")).alias("n"), F.col(column).alias("v"))).alias("m")).first()
    return top["m"]


def _fill_ordered(df: DataFrame, rules: Mapping[str, str], keys: Sequence[str], order: str,
                  tiebreak: Sequence[str]) -> DataFrame:
    window = SplitWindow(df, keys, order, tiebreak)
    for c, rule in rules.items():
        at = F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col(order).alias("o")))
        if rule in ("forward", "interpolate"):
            window.last_seen(f"__before_{c}", at)
        if rule in ("backward", "interpolate"):
            window.next_seen(f"__after_{c}", at)
    filled = window.result()
    out: dict[str, Column] = {}
    for c, rule in rules.items():
        if rule == "forward":
            out[c] = F.coalesce(F.col(c), F.col(f"__before_{c}")["v"])
        elif rule == "backward":
            out[c] = F.coalesce(F.col(c), F.col(f"__after_{c}")["v"])
        else:
            a, b, here = F.col(f"__before_{c}"), F.col(f"__after_{c}"), _seconds(df, F.col(order), order)
            start, end = _seconds(df, a["o"], order), _seconds(df, b["o"], order)
            between = a["v"] + (b["v"] - a["v"]) * (here - start) / F.nullif(end - start, F.lit(0))
            out[c] = F.coalesce(F.col(c).cast("double"), between)
    return filled.withColumns(out)


def _seconds(df: DataFrame, c: Column, order: str) -> Column:
    kind = df.schema[order].dataType.typeName()
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp"))
    return F.unix_date(c) if kind == "date" else c


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None, threshold: float | None = None) -> DataFrame:
    """Drop rows with a NULL in ``columns``, or with more than ``threshold`` of all columns NULL."""
    if threshold is not None:
        allowed = int(len(df.columns) * threshold)
        return df.dropna(thresh=len(df.columns) - allowed) if allowed < len(df.columns) else df
    return df.dropna(subset=list(columns) if columns else None)


def without_nulls(df: DataFrame, columns: Sequence[str], threshold: float | None = None) -> Column:
    """What :func:`drop_nulls` keeps, as a condition; NaN counts as NULL, as it does there."""
    def is_filled(c: str) -> Column:
        column = F.col(f"`{c}`")
        return column.isNotNull() & ~F.isnan(column) if df.schema[c].dataType.typeName() in ("float", "double") else column.isNotNull()

    if threshold is None:
        return reduce(lambda a, b: a & b, [is_filled(c) for c in columns], F.lit(True))
    allowed = int(len(columns) * threshold)
    return reduce(lambda a, b: a + b, [is_filled(c).cast("int") for c in columns], F.lit(0)) >= len(columns) - allowed


# -- deduplication -----------------------------------------------------------------------------------------

def deduplicate(df: DataFrame, keys: Sequence[str], keep: str = "first",
                sort_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first or last in ``sort_by`` order; remaining columns break ties.

    ``row_number() = 1`` is planned with a window group limit on both sides of the shuffle, so each task sends
    one row per key and a hot key costs no more than the number of tasks that saw it.
    """
    order = _total_order(df, df.columns, keys, keep, sort_by)
    sort = [F.col(c).asc_nulls_first() if keep == "first" else F.col(c).desc_nulls_last() for c in order]
    if not sort:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def _total_order(df: DataFrame, columns: Sequence[str], keys: Sequence[str], keep: str, sort_by: Sequence[str] | None) -> list[str]:
    """``sort_by``, then all other ``columns`` that can be ordered."""
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    order = list(sort_by or [])
    return order + [c for c in columns if c not in order and c not in keys and not df.schema[c].dataType.simpleString().startswith(("map", "variant"))]


def deduplicate_in_ledger(df: DataFrame, keys: Sequence[str], keep: str, sort_by: Sequence[str] | None, step: int) -> DataFrame:
    """:func:`deduplicate` on a frame with a ledger: the dropped rows stay as ghosts of ``step``."""
    order = _total_order(df, ledger.data_columns(df), keys, keep, sort_by)
    return ledger.deduplicated(df, keys, order, keep == "last", step)


def deduplicate_by_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop exact re-deliveries: rows whose hash over ``columns`` was seen before."""
    hashed = df.withColumn("_row_hash", text.row_hash(columns))
    return hashed.dropDuplicates(["_row_hash"])


def deduplicate_fuzzy(df: DataFrame, id_column: str, name: str) -> DataFrame:
    """Keep a row unless a row with a lower id has the same normalised name, or one that is one edit away.

    No pairs are formed. Every name lists its texts with one character left out. Names that leave out the same
    position and agree in the rest differ by one replacement; a name that equals another's shortened text
    differs by one insertion. Rows without a name are all kept. Both are minima over groups no larger than length times alphabet, because equal
    names were merged before, so copies of one name cannot make a group large.
    """
    norm = text.standardize(F.col(name), remove_special=True)
    names = (df.filter(F.col(name).isNotNull()).groupBy(norm.alias("__norm")).agg(F.min(id_column).alias("__id")))
    size = F.length("__norm")
    cut = F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: F.concat(
        F.substring(F.col("__norm"), F.lit(1), i - 1), F.substring(F.col("__norm"), i + 1, size)))
    shortened = names.filter(size > 0).select("__id", F.posexplode(cut).alias("__at", "__text"))
    whole = names.select("__id", F.lit(-1).alias("__at"), F.col("__norm").alias("__text"))
    near, same = Window.partitionBy("__text"), Window.partitionBy("__text", "__at")
    is_whole = F.col("__at") == -1
    seen = shortened.unionByName(whole).select(
        "__id", "__at",
        F.min("__id").over(same).alias("__replaced"),
        F.min(F.when(is_whole, F.col("__id"))).over(near).alias("__whole"),
        F.min(F.when(~is_whole, F.col("__id"))).over(near).alias("__short"))
    earlier = F.least("__replaced", F.when(is_whole, F.col("__short")).otherwise(F.col("__whole")))
    dropped = seen.filter(earlier < F.col("__id")).select("__id").distinct()
    kept = names.join(dropped, "__id", "left_anti").select(F.col("__id").alias(id_column))
    return df.filter(F.col(name).isNotNull()).join(kept, id_column, "left_semi").select(*df.columns).unionByName(
        df.filter(F.col(name).isNull()))


# -- outliers ----------------------------------------------------------------------------------------------

def remove_outliers(df: DataFrame, column: str, method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    """Keep rows inside the fence; NULL values go too. The bounds are literals, so the filter reaches the scan."""
    return df.filter(inside_fence(df, column, method, threshold))


def inside_fence(df: DataFrame, column: str, method: str = "iqr", threshold: float = 1.5) -> Column:
    """What :func:`remove_outliers` keeps, as a condition with literal bounds."""
    c = F.col(column)
    stats = column_stats(df, {column: c})
    if method == "iqr":
        q = exact_quantiles(df, {column: c}, {column: [0.25, 0.75]}, stats)[column]
        if q[0.25] is None:
            return c.isNotNull()
        reach = threshold * (q[0.75] - q[0.25])
        return (c >= q[0.25] - reach) & (c <= q[0.75] + reach)
    if method != "zscore":
        raise ValueError("method must be 'iqr' or 'zscore'")
    mean, std = stats[column]["mean"], stats[column]["std"]
    if not std:
        return c.isNotNull()
    return F.abs((c - mean) / std) <= threshold


def flag_outliers(df: DataFrame, column: str, n_std: float = 3.0, output: str = "is_outlier") -> DataFrame:
    """Mark rows further than ``n_std`` deviations from the table mean (a scalar subquery, no window)."""
    stats = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")).alias("s")).scalar()
    return df.withColumn(output, F.abs(F.col(column) - stats["mean"]) > n_std * stats["std"])


# -- the fluent cleaner ------------------------------------------------------------------------------------

@dataclass
class Cleaner:
    """Collects cleaning steps on one lazy plan; ``clean()`` returns the frame, ``report()`` the effect of each.

    Example: ``Cleaner(df).standardize(["name"]).fill_nulls({"qty": 0}).deduplicate(["id"]).clean()``
    """

    source: DataFrame
    steps: list[tuple[str, str, Callable[[DataFrame], DataFrame]]] = field(default_factory=list)
    # How each step runs on a frame with a ledger: a function of frame and step number. NULL: it may do anything.
    deferred: list[Callable[[DataFrame, int], DataFrame] | None] = field(default_factory=list)

    def apply(self, name: str, detail: str, fn: Callable[[DataFrame], DataFrame],
              deferred: Callable[[DataFrame, int], DataFrame] | None = None) -> "Cleaner":
        """Add any step. Without ``deferred`` the report measures the frame before and after each step."""
        self.steps.append((name, detail, fn))
        self.deferred.append(deferred)
        return self

    def _project(self, name: str, detail: str, fn: Callable[[DataFrame], DataFrame]) -> "Cleaner":
        """A step that only changes columns."""
        return self.apply(name, detail, fn, lambda d, _: fn(d))

    def _keep(self, name: str, detail: str, fn: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], Column]) -> "Cleaner":
        """A step that only drops rows, those that ``keep`` is not true for."""
        return self.apply(name, detail, fn, lambda d, step: ledger.dropped(d, keep(ledger.silenced(d)), step))

    def standardize(self, columns: Sequence[str], **options: Any) -> "Cleaner":
        return self._project("strings_standardized", ",".join(columns),
                          lambda d: on_columns(d, columns, lambda c: text.standardize(c, **options)))

    def clean_phones(self, column: str, country_code: str = text.COUNTRY_CODE, output: str | None = None) -> "Cleaner":
        return self._project("phones_cleaned", column,
                          lambda d: d.withColumn(output or column, text.clean_phone(F.col(column), country_code)))

    def clean_emails(self, column: str) -> "Cleaner":
        return self._project("emails_cleaned", column, lambda d: on_columns(d, [column], text.clean_email))

    def fill_nulls(self, rules: Mapping[str, Any], **options: Any) -> "Cleaner":
        def deferred(d: DataFrame, step: int) -> DataFrame:
            columns = _present(d, list(rules))
            out = fill_nulls(ledger.with_null_marks(ledger.silenced(d), columns), rules, **options)
            return ledger.filled(out, columns, step)

        return self.apply("nulls_filled", ",".join(rules), lambda d: fill_nulls(d, rules, **options), deferred)

    def drop_nulls(self, columns: Sequence[str] | None = None, threshold: float | None = None) -> "Cleaner":
        return self._keep("null_rows_dropped", ",".join(columns or []), lambda d: drop_nulls(d, columns, threshold), lambda d: without_nulls(
            d, ledger.data_columns(d) if threshold is not None or not columns else columns, threshold))

    def deduplicate(self, keys: Sequence[str], keep: str = "first", sort_by: Sequence[str] | None = None) -> "Cleaner":
        return self.apply("duplicates_removed", ",".join(keys), lambda d: deduplicate(d, keys, keep, sort_by),
                          lambda d, step: deduplicate_in_ledger(d, keys, keep, sort_by, step))

    def rename(self, mapping: Mapping[str, str]) -> "Cleaner":
        return self._project("columns_renamed", ",".join(mapping), lambda d: rename_columns(d, mapping))

    def drop_columns(self, columns: Sequence[str]) -> "Cleaner":
        return self._project("columns_dropped", ",".join(columns), lambda d: drop_columns(d, columns))

    def reorder(self, columns: Sequence[str]) -> "Cleaner":
        return self._project("columns_reordered", ",".join(columns), lambda d: reorder_columns(d, columns))

    def add_column(self, name: str, value: Any) -> "Cleaner":
        return self._project("column_added", name, lambda d: add_column(d, name, value))

    def filter(self, condition: Column | str) -> "Cleaner":
        return self._keep("rows_filtered", "", lambda d: filter_rows(d, condition), lambda d: F.expr(condition) if isinstance(condition, str) else condition)

    def coalesce(self, output: str, sources: Sequence[str]) -> "Cleaner":
        return self._project("columns_coalesced", output, lambda d: coalesce_columns(d, output, sources))

    def map_values(self, column: str, mapping: Mapping[Any, Any], default: Any = None,
                   keep_unmapped: bool = False) -> "Cleaner":
        return self._project("values_mapped", column, lambda d: on_columns(
            d, [column], lambda c: values.map_values(c, mapping, default, keep_unmapped)))

    def clip(self, column: str, low: float | None = None, high: float | None = None) -> "Cleaner":
        return self._project("values_clipped", column,
                          lambda d: on_columns(d, [column], lambda c: values.clip(c, low, high)))

    def to_date(self, column: str, fmt: str = text.DATE_FORMAT, strict: bool = False) -> "Cleaner":
        return self._project("dates_parsed", column,
                          lambda d: on_columns(d, [column], lambda c: text.parse_date(c, fmt, strict)))

    def to_datetime(self, column: str, fmt: str = text.DATETIME_FORMAT, strict: bool = False) -> "Cleaner":
        return self._project("datetimes_parsed", column,
                          lambda d: on_columns(d, [column], lambda c: text.parse_datetime(c, fmt, strict)))

    def to_numeric(self, column: str, dtype: str = "double") -> "Cleaner":
        return self._project("numbers_parsed", column,
                          lambda d: on_columns(d, [column], lambda c: text.parse_number(c, dtype)))

    def remove_outliers(self, column: str, method: str = "iqr", threshold: float = 1.5) -> "Cleaner":
        return self._keep("outliers_removed", column, lambda d: remove_outliers(d, column, method, threshold),
                          lambda d: inside_fence(d, column, method, threshold))

    def clean(self) -> DataFrame:
        return reduce(lambda d, step: step[2](d), self.steps, self.source)

    def report(self) -> DataFrame:
        """One row per step: what it did, to which columns, and how many rows or values it changed.

        One pass: rows that a step drops stay in the frame as ghosts with its number, and one aggregate counts them all.
        Statistics that a step needs (means, fences) are worked out beforehand, as in :meth:`clean`. Accumulator
        metrics would count twice when a lost executor makes a stage run again.
        """
        if any(step is None for step in self.deferred):
            return self._measured()
        frame = ledger.opened(self.source)
        affected: list[Column] = []
        for i, ((name, detail, _), step) in enumerate(zip(self.steps, self.deferred)):
            frame = step(frame, i)
            if name in _ROW_STEPS:
                affected.append(F.sum(F.when(F.col(ledger.STEP) == i, F.col(ledger.WEIGHT))))
            elif name == "nulls_filled":
                affected.append(F.sum(f"{ledger.FILLED}{i}"))
            else:
                affected.append(F.lit(len([c for c in detail.split(",") if c])))
        cells = [F.struct(F.lit(i).alias("step"), F.lit(name).alias("action"), F.lit(detail).alias("columns"),
                          F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("long").alias("affected")) for i, (name, detail, _) in enumerate(self.steps)]
        if not cells:
            return self.source.sparkSession.createDataFrame([], "step int, action string, columns string, affected bigint")
        one = frame.agg(F.count(F.lit(1)).alias("n"), *[n.alias(f"n{i}") for i, n in enumerate(affected)])
        return one.select(F.inline(F.array(*cells)))

    def _measured(self) -> DataFrame:
        """The report for steps that may do anything: every frame before and after a counted step is measured once."""
        frames = [self.source]
        for _, _, fn in self.steps:
            frames.append(fn(frames[-1]))
        fills = {i: [c for c in detail.split(",") if c in frames[i].columns]
                 for i, (name, detail, _) in enumerate(self.steps) if name == "nulls_filled"}
        counted = {i for i, (name, _, _) in enumerate(self.steps) if name in _ROW_STEPS}
        parts = []
        for i in sorted({j for s in counted | set(fills) for j in (s, s + 1)}):
            cells = sorted({c for s in (i, i - 1) for c in fills.get(s, [])})
            wanted = [("", F.count(F.lit(1))), *[(c, F.count(F.when(F.col(c).isNull(), 1))) for c in cells]]
            parts.append(frames[i].agg(F.map_from_arrays(F.array(*[F.lit(f"{i}|{c}") for c, _ in wanted]),
                                                         F.array(*[n for _, n in wanted])).alias("m")))
        # One map entry per step and filled column: a handful, whatever the table size.
        found = (reduce(DataFrame.unionByName, parts).select(F.explode("m").alias("k", "n")) if parts else
                 self.source.sparkSession.createDataFrame([], "k string, n bigint"))
        one = found.agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m"))
        m = F.col("m")
        rows = []
        for i, (name, detail, _) in enumerate(self.steps):
            if i in fills:
                gaps = [m[f"{i}|{c}"] - m[f"{i + 1}|{c}"] for c in fills[i]]
                affected = text.horizontal_sum(gaps) if gaps else F.lit(0)
            elif i in counted:
                affected = m[f"{i}|"] - m[f"{i + 1}|"]
            else:
                affected = F.lit(len([c for c in detail.split(",") if c]))
            rows.append(F.struct(F.lit(i).alias("step"), F.lit(name).alias("action"), F.lit(detail).alias("columns"),
                                 affected.cast("long").alias("affected")))
        return one.select(F.inline(F.array(*rows)))


_ROW_STEPS = ("duplicates_removed", "outliers_removed", "rows_filtered", "null_rows_dropped")


def quick_clean(df: DataFrame, strings: Sequence[str] = (), fills: Mapping[str, Any] | None = None,
                keys: Sequence[str] = ()) -> DataFrame:
    """Standardise strings, fill NULLs, deduplicate: the usual three steps."""
    cleaner = Cleaner(df)
    if strings:
        cleaner.standardize(strings)
    if fills:
        cleaner.fill_nulls(fills)
    if keys:
        cleaner.deduplicate(keys)
    return cleaner.clean()
