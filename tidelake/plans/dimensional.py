"""Star-schema building: surrogate keys, slowly changing dimensions, dimensions and facts."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.values import date_key
from tidelake.operators.split_window import SplitWindow, null_safe_join

# Fixed value: key of the "unknown" member for rows without a dimension entry.
UNKNOWN_KEY = -1
OPEN_END = dt.date(9999, 12, 31)


def surrogate_keys(df: DataFrame, natural: str, output: str, start: int = 1) -> DataFrame:
    """Dense keys in natural-key order; the numbering is cut into blocks, never one partition."""
    numbered = SplitWindow(df, [], natural).position("__n").result()
    return numbered.select((F.col("__n") + (start - 1)).alias(output), *df.columns)


# -- SCD type 2 --------------------------------------------------------------------------------------------

def scd2_history(changes: DataFrame, key: str, attributes: Sequence[str], date: str) -> DataFrame:
    """Versions with ``effective_from``, ``effective_to`` (exclusive) and ``is_current`` from dated snapshots.

    A version starts where the attributes differ from the row before, NULL being a value of its own. Both steps are ordered per key through
    split windows, so a key with a very long history is spread over tasks.
    """
    dated = changes.select(key, *attributes, F.col(date).alias("effective_from")).withColumn("__now", F.struct(*attributes))
    steps = SplitWindow(dated, [key], "effective_from", list(attributes)).previous("__before", F.struct(F.col("__now").alias("was")))
    starts = steps.result().filter(F.col("__before").isNull() | ~F.col("__before.was").eqNullSafe(F.col("__now")))
    closed = SplitWindow(starts.drop("__before", "__now"), [key], "effective_from", list(attributes), hot=steps.hot).following(
        "effective_to", F.col("effective_from")).result()
    return closed.select(key, *attributes, "effective_from", "effective_to",
                         F.col("effective_to").isNull().alias("is_current"))


def scd2_apply(dimension: DataFrame, snapshot: DataFrame, key: str, attributes: Sequence[str],
               as_of: Column) -> DataFrame:
    """Close changed current rows at ``as_of``, insert their new versions and new keys, keep everything else.

    Keys absent from the snapshot stay current. ``snapshot`` must hold one row per key.
    """
    columns = [key, *attributes, "effective_from", "effective_to", "is_current"]
    current = dimension.filter("is_current").select(*columns)
    past = dimension.filter(~F.col("is_current")).select(*columns)
    new = snapshot.select(key, F.struct(*attributes).alias("__new"))
    both = current.withColumn("__old", F.struct(*attributes)).join(new, key, "full_outer")
    is_new = F.col("__old").isNull()
    changed = ~is_new & F.col("__new").isNotNull() & ~F.col("__old").eqNullSafe(F.col("__new"))
    old_row = F.when(~is_new, F.struct(
        F.col(key).alias(key), *[F.col(a).alias(a) for a in attributes], F.col("effective_from").alias("effective_from"),
        F.when(changed, as_of).otherwise(F.col("effective_to")).alias("effective_to"),
        (~changed).alias("is_current")))
    new_row = F.when(is_new | changed, F.struct(
        F.col(key).alias(key), *[F.col("__new")[a].alias(a) for a in attributes], as_of.alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"), F.lit(True).alias("is_current")))
    # Both outcomes come from one join: every joined row yields the old version, the new version, or both.
    live = both.select(F.explode(F.array_compact(F.array(old_row, new_row))).alias("r")).select("r.*")
    return past.unionByName(live.select(*columns))


def scd2_rebuild(dimension: DataFrame, late: DataFrame, key: str, attributes: Sequence[str], date: str,
                 seen: DataFrame | None = None) -> DataFrame:
    """Apply late changes: the history of affected keys is rebuilt, the others pass through. A NULL key is a key like any other.

    ``seen`` are the snapshots that the dimension was built from. A version keeps only the day it began on, so a change that falls between two
    snapshots of one version needs them: the state comes back with the second. Without ``seen`` versions stand for their snapshots, which is
    exact for changes that lie before or behind all snapshots of their key.
    """
    affected = late.select(key).distinct()
    columns = [key, *attributes, "effective_from", "effective_to", "is_current"]
    kept = null_safe_join(dimension, affected, [key], "left_anti").select(*columns)
    before = dimension.withColumn(date, F.col("effective_from")) if seen is None else seen
    known = null_safe_join(before, affected, [key], "left_semi").select(key, *attributes, date)
    return kept.unionByName(scd2_history(known.unionByName(late.select(*known.columns)), key, attributes, date))


def scd2_lookup(fact: DataFrame, dimension: DataFrame, key: str, date: str, attributes: Sequence[str]) -> DataFrame:
    """Attributes valid at the fact's date: those of the last version that began by then, unless it has ended.

    Facts and versions are merged into one ordered stream per key, so the work stays linear however many versions a
    key has, and a hot key is split over tasks. Where versions overlap, the one that began last counts; of those that
    began together, the one with the largest end.
    """
    end = F.coalesce(F.col("effective_to").cast("date"), F.lit(OPEN_END))
    version = F.struct(*attributes, end.alias("__to"))
    starts = dimension.select(F.col(key), F.col("effective_from").alias("__at"), F.lit(0).alias("__kind"), end.alias("__end"),
                              version.alias("__version"))
    facts = fact.select(F.col(key), F.col(date).alias("__at"), F.lit(1).alias("__kind"),
                        F.struct(*fact.columns).alias("__fact"))
    stream = starts.unionByName(facts, allowMissingColumns=True).withColumn(
        "__version", F.when(F.col(key).isNotNull(), F.col("__version")))
    seen = SplitWindow(stream, [key], "__at", ["__kind", "__end"]).last_seen("__valid", F.col("__version")).result()
    valid = F.when(F.col("__at") < F.col("__valid.__to"), F.col("__valid"))
    return seen.filter("__kind = 1").select("__fact.*", *[valid[a].alias(a) for a in attributes])


# -- dimensions --------------------------------------------------------------------------------------------

def dim_product(product: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Product dimension: ``columns`` maps output names to source columns; keys in ``sku_code`` order."""
    picked = product.select(*[F.col(source).alias(name) for name, source in columns.items()])
    return surrogate_keys(picked, "sku_code", "product_key")


def dim_location(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = (supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
              .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("s_suppkey").alias("location_id"), F.col("s_name").alias("location_name"),
                      F.col("n_name").alias("country"), F.col("r_name").alias("region")))
    return surrogate_keys(places, "location_id", "location_key")


def dim_customer(customer: DataFrame, nation: DataFrame) -> DataFrame:
    people = (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                      F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("country")))
    return surrogate_keys(people, "customer_id", "customer_key")


# -- facts -------------------------------------------------------------------------------------------------

def with_dimension_key(fact: DataFrame, dimension: DataFrame, natural: str, fact_column: str,
                       surrogate: str) -> DataFrame:
    """Left join one dimension key; unmatched rows get the unknown key."""
    keys = dimension.select(F.col(natural).alias("__nk"), surrogate)
    return (fact.join(keys, F.col(fact_column) == F.col("__nk"), "left").drop("__nk")
            .withColumn(surrogate, F.coalesce(F.col(surrogate), F.lit(UNKNOWN_KEY).cast("long"))))


def fact_sales(lines: DataFrame, orders: DataFrame, product: DataFrame, location: DataFrame,
               customer: DataFrame) -> DataFrame:
    """Order lines with product, location, customer, order-date and ship-date keys.

    The customer is looked up per order, before lines multiply it.
    """
    heads = with_dimension_key(orders, customer, "customer_id", "o_custkey", "customer_key").select("o_orderkey", "o_orderdate", "customer_key")
    sales = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    sales = with_dimension_key(sales, product, "sku_code", "l_partkey", "product_key")
    sales = with_dimension_key(sales, location, "location_id", "l_suppkey", "location_key")
    return sales.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), "product_key",
        "location_key", "customer_key", date_key(F.col("o_orderdate")).alias("date_key"),
        date_key(F.col("l_shipdate")).alias("ship_date_key"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("gross_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


def fact_inventory(stock: DataFrame, product: DataFrame, location: DataFrame) -> DataFrame:
    """Snapshot rows (``sku_code, location_id, snapshot_date, quantity_on_hand, quantity_reserved, unit_cost``)
    with keys and the calculated measures."""
    keyed = with_dimension_key(stock, product.withColumnRenamed("sku_code", "__sku"), "__sku", "sku_code", "product_key")
    keyed = with_dimension_key(keyed, location.withColumnRenamed("location_id", "__loc"), "__loc", "location_id",
                               "location_key")
    on_hand, reserved = F.col("quantity_on_hand"), F.col("quantity_reserved")
    cost = F.col("unit_cost").cast("decimal(10,2)")
    return keyed.select("product_key", "location_key", date_key(F.col("snapshot_date")).alias("date_key"),
                        on_hand, reserved, (on_hand - reserved).alias("quantity_available"), cost.alias("unit_cost"),
                        (on_hand.cast("decimal(12,0)") * cost).cast("decimal(15,2)").alias("total_value"))


def fact_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order: lines, first and last ship date, lead days, fulfilled when every line is final.

    Lines are aggregated before the join, so no order fans out.
    """
    shipped = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("quantity"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        F.count(F.when(F.col("l_linestatus") != "F", F.lit(1))).alias("open_lines"))
    joined = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                         date_key(F.col("o_orderdate")).alias("date_key"),
                         F.coalesce("line_count", F.lit(0).cast("long")).alias("line_count"), "quantity",
                         F.datediff("first_ship", "o_orderdate").alias("lead_days"),
                         F.datediff("last_ship", "o_orderdate").alias("completion_days"),
                         F.coalesce(F.col("open_lines") == 0, F.lit(False)).alias("is_fulfilled"))


def unify_sources(sources: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Frames of differing shape to one table: ``{source: (frame, {output: input})}``; absent columns are NULL."""
    parts = [df.select(F.lit(name).alias("source"), *[F.col(c).alias(out) for out, c in mapping.items()])
             for name, (df, mapping) in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
