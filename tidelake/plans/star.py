"""A stored star schema: surrogate keys that last, dimensions, and facts that are loaded by period.

Keys are never renumbered. A registry holds ``(natural key, surrogate key)`` of everything a dimension has ever held; a load
looks up what it knows and numbers only the rest, behind the highest key handed out so far. That height is raised *before* the keys
are written, so a load that breaks off leaves a gap, never a number twice. One load of a table may run at a time.

Facts are partitioned by a period. A load replaces the periods it brings and leaves the others alone; rows that the
replaced period held before keep their own key too. Rows without a dimension entry get :data:`UNKNOWN_KEY`; dates are
looked up in the stored calendar like any other dimension.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.functions.values import calendar
from tidelake.operators.split_window import null_safe_join
from tidelake.plans.dimensional import UNKNOWN_KEY
from tidelake.session import file_per_task, materialise, parallelism
from tidelake.sinks.tables import LAYER_CODEC, require_unique, write_table
from tidelake.sources.files import path_exists


class Numbers:
    """The highest number handed out under a path: an append-only table of one row a load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def take(self, count: int) -> int:
        """Reserve ``count`` numbers; returns the first."""
        top = 0
        if path_exists(self.spark, self.path):
            top = self.spark.read.schema("top bigint").parquet(self.path).agg(F.max("top")).first()[0] or 0
        if count:
            self.spark.range(1).select(F.lit(top + count).cast("bigint").alias("top")).write.mode("append").parquet(self.path)
        return top + 1


AT, AGAIN = "__at", "__again"
# Rows of a fact are written up to three times before they are in it.
SCRATCH_CODEC = "zstd"


@dataclass
class Placed:
    """Rows written once in sorted ranges of ``order`` (NULLs first); :data:`AT` is their place, block and position in it."""

    table: DataFrame
    order: list[str]
    unique: bool = False
    whole: bool = True

    def filter(self, condition: Column | str) -> "Placed":
        return Placed(self.table.filter(condition), self.order, self.unique, False)

    @property
    def rows(self) -> DataFrame:
        return self.table.drop(AT)

    def numbered(self, output: str, numbers: Numbers) -> DataFrame:
        """Rows with numbers behind all that were handed out, in order.

        What a filter left is written with new places, each range where it lies; no row moves.
        """
        table = self.table
        if not self.whole:
            with file_per_task(table.sparkSession):  # so a task goes through one range, in its order
                table = materialise(table.withColumnRenamed(AT, "__was").withColumn(AT, F.monotonically_increasing_id()), "numbered", SCRATCH_CODEC)
        block, within = _block(), F.col(AT).bitwiseAND(F.lit((1 << 33) - 1))
        place = F.col(AT if self.whole else "__was")
        found = table.groupBy(block.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("low"), F.max(place).alias("high")).collect()
        found.sort(key=lambda r: r["low"])
        if any(a["high"] >= b["low"] for a, b in zip(found, found[1:])):
            raise ValueError("ranges of placed rows overlap")
        starts = list(accumulate((r["n"] for r in found), initial=0))
        first = numbers.take(starts[-1])
        at = [0] * (max((r["b"] for r in found), default=0) + 1)
        for r, start in zip(found, starts):
            at[r["b"]] = first + start
        return table.select(*self.rows.columns, (F.get(F.lit(at).cast("array<bigint>"), block.cast("int")) + within).alias(output))


def _block() -> Column:
    return F.shiftright(AT, 33)


def placed(rows: DataFrame, order: Sequence[str], unique: bool = False, ranged: bool = False) -> Placed:
    """``rows`` written in sorted ranges. ``unique`` refuses rows that agree in ``order``.

    Rows move once. ``ranged`` ones lie in ranges already and are sorted where they lie; if it turns out that ranges overlap, they move after all.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    dealt = (rows if ranged else rows.repartitionByRange(*by)).sortWithinPartitions(*by)
    if unique:  # rows that agree share a range, so they are counted where they lie
        dealt = dealt.withColumn(AGAIN, F.row_number().over(Window.partitionBy(*order).orderBy(*by)) > 1)
    table = materialise(dealt.withColumn(AT, F.monotonically_increasing_id()), "placed", SCRATCH_CODEC)
    if ranged and _overlap(table, order):
        return placed(table.drop(AT, AGAIN), order, unique)
    if unique and not table.filter(AGAIN).isEmpty():
        raise ValueError(f"keys {list(order)} repeat in the rows to number")
    return Placed(table.drop(AGAIN), list(order), unique)


def _overlap(table: DataFrame, order: Sequence[str]) -> bool:
    """Whether a range begins before the one written ahead of it has ended; only the first and the last row of each are compared."""
    tops = table.groupBy(_block().alias("b")).agg(F.max(AT).alias("top"))
    ends = [at for r in tops.collect() for at in {r["b"] << 33, r["top"]}]
    edges = table.filter(F.col(AT).isin(ends)).groupBy(_block().alias("b")).agg(*[f(F.struct(*order)).alias(n) for n, f in (("low", F.min), ("high", F.max))])
    return not edges.select((F.lag("high").over(Window.orderBy("b")) >= F.col("low")).alias("mixed")).filter("mixed").isEmpty()


def numbered(rows: DataFrame, order: Sequence[str], output: str, numbers: Numbers) -> DataFrame:
    """``rows`` with numbers behind all that were handed out, in the order of ``order`` (NULLs first).

    Rows move once, into sorted ranges, and are written with their place; one count per range comes back to the driver.
    """
    return placed(rows, order).numbered(output, numbers)


class KeyRegistry:
    """Lasting surrogate keys: a table of natural columns and key. NULL natural keys get none."""

    def __init__(self, spark: SparkSession, path: str, natural: Sequence[str], key: str):
        self.spark, self.path, self.natural, self.key = spark, path.rstrip("/"), list(natural), key

    def read(self) -> DataFrame | None:
        table = f"{self.path}/keys"
        return self.spark.read.parquet(table) if path_exists(self.spark, table) else None

    def register(self, rows: DataFrame) -> DataFrame:
        """All keys, those of natural keys in ``rows`` that were not known included."""
        new = rows.select(*self.natural).dropna().distinct()
        known = self.read()
        if known is not None:
            new = new.join(known, self.natural, "left_anti")
        new = materialise(new, "new-keys")
        if not new.isEmpty() or known is None:
            keyed = numbered(new, self.natural, self.key, Numbers(self.spark, f"{self.path}/numbers"))
            keyed.write.mode("append").parquet(f"{self.path}/keys")
        return self.read()


class StarSchema:
    """Dimensions and facts below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.naturals: dict[str, tuple[list[str], str]] = {}

    def path(self, kind: str, name: str) -> str:
        return f"{self.root}/{kind}/{name}"

    def load_dimension(self, name: str, rows: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
        """Write a dimension (one row per natural key) with its lasting keys; entries that are no longer delivered go,
        their keys stay reserved."""
        require_unique(rows, natural)
        registry = KeyRegistry(self.spark, self.path("keys", name), natural, key).register(rows)
        rest = [c for c in rows.columns if c not in natural]
        keyed = rows.join(registry, list(natural)).select(key, *natural, *rest)
        write_table(keyed, self.path("dimensions", name), codec=LAYER_CODEC["gold"])
        return self.dimension(name, natural, key)

    def load_calendar(self, dates: DataFrame, column: str) -> DataFrame:
        """The time dimension: one row per day between the first and the last date, its key is the day as yyyymmdd."""
        write_table(calendar(dates, column), self.path("dimensions", "dim_time"), codec=LAYER_CODEC["gold"])
        return self.dimension("dim_time", ["full_date"], "date_key")

    def dimension(self, name: str, natural: Sequence[str] | None = None, key: str | None = None) -> DataFrame:
        if natural is not None:
            self.naturals[name] = (list(natural), key)
        return self.spark.read.parquet(self.path("dimensions", name))

    def with_keys(self, rows: DataFrame, lookups: Mapping[str, tuple[str, Column]]) -> DataFrame:
        """Add a key per lookup ``{output: (dimension, natural key of the row)}``; unknown ones get the unknown key."""
        for output, (name, value) in lookups.items():
            (natural,), key = self.naturals[name]
            entry = self.dimension(name).select(F.col(natural).alias("__natural"), F.col(key).alias("__key"))
            unknown = F.lit(UNKNOWN_KEY).cast(entry.schema["__key"].dataType)
            rows = (rows.withColumn("__value", value).join(entry, F.col("__value") == F.col("__natural"), "left")
                    .withColumn(output, F.coalesce("__key", unknown)).drop("__value", "__natural", "__key"))
        return rows

    def load_fact(self, name: str, rows: DataFrame | Placed, period: str, grain: Sequence[str] = (), key: str | None = None,
                  derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Replace the periods that ``rows`` brings. With ``key`` every row of ``grain`` gets a lasting number.

        Only the replaced periods are read for the keys that rows have had; what is new is numbered behind all others. Where none of
        the periods is there yet, rows take their number in one move, :class:`Placed` ones of the same ``grain`` in none.
        ``derive`` adds what follows from a row alone, behind the move into periods.
        """
        table = self.path("facts", name)
        if key is not None:
            ready = isinstance(rows, Placed) and rows.unique and rows.order == list(grain)
            source, rows, known = rows, rows.rows if isinstance(rows, Placed) else rows, None
            columns = rows.columns
            if path_exists(self.spark, table):
                rows = rows if isinstance(source, Placed) else materialise(rows, "fact-rows")
                periods = [r[0] for r in rows.select(period).distinct().collect()]
                stored = self.spark.read.parquet(table).filter(F.col(period).isin([p for p in periods if p is not None]) | F.col(period).isNull())
                known = None if stored.isEmpty() else stored.select(*grain, key)
            numbers, old = Numbers(self.spark, self.path("keys", name)), None
            if known is not None:
                rows, ready = materialise(null_safe_join(rows, known, grain, "left"), "fact-known", SCRATCH_CODEC), False
                old, rows = rows.filter(F.col(key).isNotNull()).select(key, *columns), rows.filter(F.col(key).isNull()).select(*columns)
                if not (isinstance(source, Placed) and source.unique and set(source.order) <= set(grain)):
                    require_unique(old, [key])  # rows that agree found the same key
            rows = (source if ready else placed(rows, grain, unique=True)).numbered(key, numbers).select(key, *columns)
            rows = rows if old is None else old.unionByName(rows)
        write_table(rows, table, [period], codec=LAYER_CODEC["gold"], dynamic=True, derive=derive)
        return self.fact(name)

    def fact(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("facts", name))


def month_of(day: Column) -> Column:
    """The period of a monthly fact: yyyymm."""
    return F.year(day) * 100 + F.month(day)


# -- facts -------------------------------------------------------------------------------------------------

def order_lines(star: StarSchema, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order-line grain: ordered and fulfilled quantity, amounts, lead days, keys of all dimensions.

    Keys of the order (customer, channel, date) are looked up on orders, before lines multiply them.
    """
    heads = star.with_keys(orders, {"customer_key": ("dim_customer", F.col("o_custkey")), "channel_key": ("dim_channel", F.col("o_orderpriority")),
                                    "date_key": ("dim_time", F.to_date("o_orderdate"))})
    heads = heads.select(F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("ordered"), "customer_key", "channel_key", "date_key")
    sold = lines.join(heads, F.col("l_orderkey") == F.col("order_id"))
    sold = star.with_keys(sold, {"product_key": ("dim_product", F.col("l_partkey")), "supplier_key": ("dim_supplier", F.col("l_suppkey")),
                                 "ship_date_key": ("dim_time", F.to_date("l_shipdate"))})
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return sold.select(
        "order_id", F.col("l_linenumber").alias("line_number"), "product_key", "supplier_key", "customer_key", "channel_key", "date_key",
        "ship_date_key", quantity.alias("ordered_quantity"), F.when(F.col("l_linestatus") == "F", quantity).otherwise(0.0).alias("fulfilled_quantity"),
        price.alias("gross_amount"), (price * F.col("l_discount")).alias("discount_amount"), (price * (1 - F.col("l_discount"))).alias("revenue"),
        F.datediff("l_shipdate", "ordered").alias("lead_days"), month_of(F.col("ordered")).alias("order_month"))


def stock_snapshots(movements: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], costs: Sequence[str] = (),
                    moves: Column | None = None, tasks: int | None = None) -> DataFrame:
    """State of every key at the end of each day on which it moved, from signed daily movements.

    Movements are added up per key and day first, so a window holds a key's days at most. They move once, by key: days are added up
    and windows run where a key lies. ``costs`` carry the day's largest. ``moves``, an array of structs of ``day`` and ``measures``, makes several
    movements of a row behind the move. With ``tasks`` keys are dealt in sorted ranges, so many at least, and the result lies in them.
    """
    if tasks is None:
        dealt = movements.repartition(*keys)
    else:
        by = [F.col(k).asc_nulls_first() for k in keys]
        dealt = movements.repartitionByRange(tasks, *by) if tasks > parallelism(movements.sparkSession) else movements.repartitionByRange(*by)
    if moves is not None:
        dealt = dealt.select(*keys, *costs, F.inline(moves))
    daily = dealt.groupBy(*keys, day).agg(*[F.sum(m).alias(m) for m in measures], *[F.max(c).alias(c) for c in costs])
    upto = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(*keys, day, *[F.sum(m).over(upto).alias(m) for m in measures], *costs)


def inventory(star: StarSchema, snapshots: DataFrame) -> DataFrame:
    """Fact rows from ``sku_code, location_id, snapshot_date, on_hand, reserved, in_transit, unit_cost, last_updated``.

    Keys that snapshots carry, having been looked up before movements multiplied them, are not looked up again; a key of the row stays.
    """
    lookups = {"product_key": ("dim_product", F.col("sku_code")), "location_key": ("dim_location", F.col("location_id")),
               "date_key": ("dim_time", F.col("snapshot_date"))}
    keyed = star.with_keys(snapshots, {k: v for k, v in lookups.items() if k not in snapshots.columns})
    on_hand, cost = F.col("on_hand"), F.col("unit_cost").cast("decimal(10,2)")
    return keyed.select(
        *[c for c in ("inventory_key",) if c in snapshots.columns], "product_key", "location_key", "date_key", "sku_code", "location_id", "snapshot_date", on_hand.alias("quantity_on_hand"),
        F.col("reserved").alias("quantity_reserved"), F.col("in_transit").alias("quantity_in_transit"),
        (on_hand - F.col("reserved")).alias("quantity_available"), cost.alias("unit_cost"),
        (on_hand.cast("decimal(12,0)") * cost).cast("decimal(15,2)").alias("total_value"), "last_updated",
        month_of(F.col("snapshot_date")).alias("snapshot_month"))


def period_close(snapshots: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], until: Column) -> DataFrame:
    """Closing balance of every key at each month end up to ``until``: stock may be added up over keys, never over time.

    A snapshot holds until the next one of its key, so it is spread over the month ends in between; no join, no grid.
    """
    order = Window.partitionBy(*keys).orderBy(day)
    held = snapshots.select(*keys, day, *measures, F.lead(day).over(order).alias("__next"))
    last = F.least(F.coalesce(F.date_sub("__next", 1), until), until)
    first_end, last_end = F.last_day(F.col(day)), F.last_day(F.add_months(F.date_add(last, 1), -1))
    months = F.when(first_end <= last_end, F.sequence(F.trunc(first_end, "month"), F.trunc(last_end, "month"), F.expr("interval 1 month")))
    return held.select(*keys, F.explode(months).alias("__month"), *measures).select(*keys, F.last_day("__month").alias("month_end"), *measures)


def period_totals(movements: DataFrame, keys: Sequence[str], groups: Sequence[str], day: str, measures: Sequence[str], until: Column) -> DataFrame:
    """``groups, month_end, items`` and measures: :func:`period_close` of all ``keys``, added up over the keys of each group.

    A sum of balances is the balance of sums, so only the movements of a group and month and the keys that begin in it are counted;
    no key is spread over the month ends it is held at.
    """
    monthly = movements.repartition(*keys).groupBy(*keys, F.last_day(day).alias("month_end")).agg(*[F.sum(m).alias(m) for m in measures])
    begins = F.col("month_end") == F.min("month_end").over(Window.partitionBy(*keys))
    moved = monthly.withColumn("items", begins.cast("long")).groupBy(*groups, "month_end").agg(*[F.sum(c).alias(c) for c in ("items", *measures)])
    upto = Window.partitionBy(*groups).orderBy("month_end").rowsBetween(Window.unboundedPreceding, 0)
    balance = moved.select(*groups, F.col("month_end").alias("__end"), *[F.sum(c).over(upto).alias(c) for c in ("items", *measures)])
    return period_close(balance, groups, "__end", ["items", *measures], until)


def trailing(daily: DataFrame, keys: Sequence[str], value: str, position: Column, start: int, end: int) -> DataFrame:
    """Sum and sum of squares of ``value`` over the positions ``start..end`` around each row, missing ones being 0."""
    frame = Window.partitionBy(*keys).orderBy("__at").rangeBetween(start, end)
    return daily.withColumn("__at", position.cast("long")).withColumns({
        "__sum": F.coalesce(F.sum(value).over(frame), F.lit(0.0)),
        "__squares": F.coalesce(F.sum(F.col(value) * F.col(value)).over(frame), F.lit(0.0))}).drop("__at")


def _spread(n: int) -> Column:
    """Sample deviation of ``n`` values from their sum and sum of squares."""
    return F.sqrt(F.greatest((F.col("__squares") - F.col("__sum") * F.col("__sum") / n) / (n - 1), F.lit(0.0)))


def replenishment_by_day(daily: DataFrame, keys: Sequence[str], demand: str, z: float, lead_days: float, window: int = 90,
                         order_cost: float = 50.0, holding_cost: float = 2.0) -> DataFrame:
    """Per key and day of demand: stock parameters from the ``window`` days up to it, days without demand being 0."""
    seen = trailing(daily.select(*keys, "day", demand), keys, demand, F.unix_date("day"), -(window - 1), 0)
    rate = F.col("__sum") / window
    safety = z * F.col("demand_std") * lead_days**0.5
    return seen.withColumns({"daily_demand": rate, "demand_std": _spread(window)}).select(
        *keys, "day", "daily_demand", "demand_std", safety.alias("safety_stock"), (F.col("daily_demand") * lead_days + safety).alias("reorder_point"),
        F.sqrt(F.col("daily_demand") * (2.0 * 365.0 * order_cost / holding_cost)).alias("eoq"))


def forecast_by_week(daily: DataFrame, keys: Sequence[str], demand: str, z: float, weeks: int = 13) -> DataFrame:
    """Per key and week of demand, and for the week after the last of the table: the demand that the ``weeks`` weeks before predict.

    A flat rate with the interval of a new observation, ``z·s·√(1 + 1/weeks)``; weeks without demand are 0, the actual of the coming week is NULL.
    """
    week = F.to_date(F.date_trunc("week", F.col("day")))
    weekly = daily.groupBy(*keys, week.alias("week")).agg(F.sum(demand).alias("actual"))
    coming = weekly.agg(F.date_add(F.max("week"), 7).alias("w")).scalar()
    none = F.lit(None).cast(weekly.schema["actual"].dataType)
    rows = weekly.unionByName(weekly.select(*keys).distinct().select(*keys, coming.alias("week"), none.alias("actual")))
    seen = trailing(rows, keys, "actual", F.floor(F.unix_date("week") / 7), -weeks, -1)
    rate, reach = F.col("__sum") / weeks, z * _spread(weeks) * (1 + 1 / weeks) ** 0.5
    return seen.select(*keys, "week", "actual", rate.alias("predicted"), F.greatest(rate - reach, F.lit(0.0)).alias("lower"), (rate + reach).alias("upper"))
