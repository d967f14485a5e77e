"""Dimensions, facts, surrogate keys, slowly changing dimensions, source unification."""

import datetime as dt

from pyspark.sql import functions as F

from queries.registry import query
from tidelake.operators.split_window import TASK_ROWS
from tidelake.plans import dimensional as D
from tidelake.plans import star as S
from tidelake.plans.demand import SERVICE_Z
from tidelake.plans.dimensional import UNKNOWN_KEY
from tidelake.plans.star import StarSchema
from tidelake.session import materialise, scratch
from tidelake.sinks.tables import require_unique

DATE_KEY = "year({0}) * 10000 + month({0}) * 100 + day({0})"


def as_long(df):
    """Date parts are 64-bit in the oracle."""
    return df.select(*[F.col(c).cast("long").alias(c) if d == "int" else F.col(c) for c, d in df.dtypes])


@query("surrogate_keys", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS order_sk, o_orderkey, o_custkey FROM orders""")
def surrogate_keys(t):
    return D.surrogate_keys(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "order_sk")


@query("surrogate_keys_text", "SELECT row_number() OVER (ORDER BY c_name) AS customer_sk, c_name FROM customer")
def surrogate_keys_text(t):
    return D.surrogate_keys(t.customer.select("c_name"), "c_name", "customer_sk")


@query("dim_product", """
SELECT row_number() OVER (ORDER BY p_partkey) AS product_key, p_partkey AS sku_code, p_name AS product_name,
  p_type AS category_l1, p_brand AS brand, p_retailprice AS unit_cost FROM part""")
def dim_product(t):
    return D.dim_product(t.part, {"sku_code": "p_partkey", "product_name": "p_name", "category_l1": "p_type",
                                  "brand": "p_brand", "unit_cost": "p_retailprice"})


@query("dim_location", """
SELECT row_number() OVER (ORDER BY s_suppkey) AS location_key, s_suppkey AS location_id, s_name AS location_name, n_name AS country, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def dim_location(t):
    return D.dim_location(t.supplier, t.nation, t.region)


@query("dim_customer", """
SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS customer_name,
  c_mktsegment AS segment, n_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def dim_customer(t):
    return D.dim_customer(t.customer, t.nation)


KEYS_SQL = """
WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS product_key FROM part WHERE p_size <= 45),
s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS location_key FROM supplier),
c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer)
"""


def _dimensions(t):
    product = D.dim_product(t.part.filter("p_size <= 45"), {"sku_code": "p_partkey", "brand": "p_brand"})
    return product, D.dim_location(t.supplier, t.nation, t.region), D.dim_customer(t.customer, t.nation)


@query("fact_sales", KEYS_SQL + f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, coalesce(product_key, -1) AS product_key, coalesce(location_key, -1) AS location_key,
  coalesce(customer_key, -1) AS customer_key, {DATE_KEY.format('o_orderdate')} AS date_key, {DATE_KEY.format('l_shipdate')} AS ship_date_key,
  l_quantity AS quantity, l_extendedprice AS gross_amount, round(l_extendedprice * l_discount, 4) AS discount_amount,
  round(l_extendedprice * (1 - l_discount), 4) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN p ON l_partkey = p_partkey LEFT JOIN s ON l_suppkey = s_suppkey
LEFT JOIN c ON o_custkey = c_custkey""")
def fact_sales(t):
    out = D.fact_sales(t.lineitem, t.orders, *_dimensions(t))
    out = out.withColumns({c: F.round(c, 4) for c in ("discount_amount", "revenue")})
    return out.withColumns({c: F.col(c).cast("long") for c in ("date_key", "ship_date_key")})


def _snapshot(t):
    """Stock per part and supplier from the order lines: everything bought, a fifth of it reserved."""
    quantity = F.sum("l_quantity").cast("long")
    stock = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(quantity.alias("quantity_on_hand"), F.max("l_shipdate").alias("last"))
    stock = stock.join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    return stock.select(F.col("l_partkey").alias("sku_code"), F.col("l_suppkey").alias("location_id"),
                        F.to_date("last").alias("snapshot_date"), "quantity_on_hand",
                        F.floor(F.col("quantity_on_hand") / 5).alias("quantity_reserved"), F.col("p_retailprice").alias("unit_cost"))


@query("fact_inventory", KEYS_SQL + f""", st AS (SELECT l_partkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS q, CAST(max(l_shipdate) AS DATE) AS d,
  CAST(any_value(p_retailprice) AS DECIMAL(10,2)) AS cost FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT coalesce(product_key, -1) AS product_key, coalesce(location_key, -1) AS location_key, {DATE_KEY.format('d')} AS date_key,
  q AS quantity_on_hand, q // 5 AS quantity_reserved, q - q // 5 AS quantity_available, cost AS unit_cost,
  CAST(q * cost AS DECIMAL(15,2)) AS total_value FROM st LEFT JOIN p ON l_partkey = p_partkey LEFT JOIN s ON l_suppkey = s_suppkey""")
def fact_inventory(t):
    product, location, _ = _dimensions(t)
    out = D.fact_inventory(_snapshot(t), product, location)
    return out.withColumn("date_key", F.col("date_key").cast("long"))


@query("fact_orders", f"""
WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q, min(l_shipdate) AS a, max(l_shipdate) AS b, count(*) FILTER (l_linestatus <> 'F') AS open_lines
  FROM lineitem GROUP BY 1)
SELECT o_orderkey AS order_id, o_custkey AS customer_id, {DATE_KEY.format('o_orderdate')} AS date_key, coalesce(n, 0) AS line_count, q AS quantity,
  date_diff('day', CAST(o_orderdate AS DATE), CAST(a AS DATE)) AS lead_days, date_diff('day', CAST(o_orderdate AS DATE), CAST(b AS DATE)) AS completion_days,
  coalesce(open_lines = 0, false) AS is_fulfilled FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def fact_orders(t):
    return as_long(D.fact_orders(t.orders, t.lineitem))


# -- slowly changing dimensions ----------------------------------------------------------------------------

SNAP_SQL = """
WITH snap AS (SELECT l_partkey AS sku, CAST(l_shipdate AS DATE) AS day, CASE WHEN avg(l_discount) > 0.06 THEN 'promo' WHEN avg(l_discount) > 0.03 THEN 'normal'
  ELSE 'full' END AS price_band, CASE WHEN max(l_quantity) > 40 THEN 'bulk' ELSE 'unit' END AS pack FROM lineitem GROUP BY 1, 2),
steps AS (SELECT *, lag(price_band || '|' || pack) OVER (PARTITION BY sku ORDER BY day) AS before FROM snap),
starts AS (SELECT * FROM steps WHERE before IS NULL OR before <> price_band || '|' || pack),
hist AS (SELECT sku, price_band, pack, day AS effective_from, lead(day) OVER (PARTITION BY sku ORDER BY day) AS effective_to FROM starts)
"""


def _snapshots(t):
    """Daily state of each part, derived from its order lines."""
    discount, top = F.round(F.avg("l_discount"), 9), F.max("l_quantity")
    band = F.when(discount > 0.06, "promo").when(discount > 0.03, "normal").otherwise("full")
    return t.lineitem.groupBy(F.col("l_partkey").alias("sku"), F.to_date("l_shipdate").alias("day")).agg(
        band.alias("price_band"), F.when(top > 40, "bulk").otherwise("unit").alias("pack"))


SNAP_SQL = SNAP_SQL.replace("avg(l_discount)", "round(avg(l_discount), 9)")


def _stored_dimension(t):
    """The dimension as a table, as later steps would find it."""
    return materialise(D.scd2_history(_snapshots(t), "sku", ["price_band", "pack"], "day"), "dim-product")


@query("scd2_history", SNAP_SQL + "SELECT *, effective_to IS NULL AS is_current FROM hist")
def scd2_history(t):
    return D.scd2_history(_snapshots(t), "sku", ["price_band", "pack"], "day")


@query("scd2_apply", SNAP_SQL + """, snap2 AS (SELECT p_partkey AS sku, 'promo' AS price_band, CASE WHEN p_size > 25 THEN 'bulk' ELSE 'unit' END AS pack FROM part),
j AS (SELECT h.*, s.price_band AS nb, s.pack AS np FROM hist h LEFT JOIN snap2 s ON h.sku = s.sku AND h.effective_to IS NULL)
SELECT sku, price_band, pack, effective_from, CASE WHEN nb IS NOT NULL AND (nb <> price_band OR np <> pack) THEN DATE '2002-01-01' ELSE effective_to END AS effective_to,
  effective_to IS NULL AND NOT (nb IS NOT NULL AND (nb <> price_band OR np <> pack)) AS is_current FROM j
UNION ALL SELECT sku, nb, np, DATE '2002-01-01', NULL, true FROM j WHERE effective_to IS NULL AND nb IS NOT NULL AND (nb <> price_band OR np <> pack)
UNION ALL SELECT sku, price_band, pack, DATE '2002-01-01', NULL, true FROM snap2 WHERE sku NOT IN (SELECT sku FROM hist)""")
def scd2_apply(t):
    dimension = _stored_dimension(t)
    today = t.part.select(F.col("p_partkey").alias("sku"), F.lit("promo").alias("price_band"),
                          F.when(F.col("p_size") > 25, "bulk").otherwise("unit").alias("pack"))
    return D.scd2_apply(dimension, today, "sku", ["price_band", "pack"], F.lit(dt.date(2002, 1, 1)))


@query("scd2_late_changes", SNAP_SQL + "SELECT *, effective_to IS NULL AS is_current FROM hist")
def scd2_late_changes(t):
    """History of the first years, then everything later arriving late, must equal the history of all rows.

    Of the first years what was shipped in the first three days of a month is late as well: it falls between days that are known, and items
    without such days pass through.
    """
    key, attributes = "sku", ["price_band", "pack"]
    snaps = materialise(_snapshots(t), "snapshots")
    early = F.coalesce(F.col("day") < F.lit(dt.date(1999, 1, 1)), F.lit(False))
    held_back = early & (F.dayofmonth("day") <= 3)
    seen = snaps.filter(early & ~held_back)
    dimension = materialise(D.scd2_history(seen, key, attributes, "day"), "scd2")
    dimension = materialise(D.scd2_rebuild(dimension, snaps.filter(held_back), key, attributes, "day", seen), "scd2")
    return D.scd2_rebuild(dimension, snaps.filter(~early), key, attributes, "day")


@query("scd2_lookup", SNAP_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, price_band, pack FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN hist ON l_partkey = sku AND CAST(o_orderdate AS DATE) >= effective_from AND CAST(o_orderdate AS DATE) < coalesce(effective_to, DATE '9999-12-31')""")
def scd2_lookup(t):
    dimension = _stored_dimension(t).withColumnRenamed("sku", "l_partkey")
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("o_orderdate").alias("day"))
    return D.scd2_lookup(fact, dimension, "l_partkey", "day", ["price_band", "pack"]).drop("day")


@query("unify_sources", """
SELECT 'store' AS source, o_orderkey AS sale_id, o_totalprice AS amount, o_orderdate AS sold_at, NULL::VARCHAR AS channel FROM orders
UNION ALL SELECT 'web', event_id, value, ts, event_type FROM events""")
def unify_sources(t):
    return D.unify_sources({
        "store": (t.orders, {"sale_id": "o_orderkey", "amount": "o_totalprice", "sold_at": "o_orderdate"}),
        "web": (t.events, {"sale_id": "event_id", "amount": "value", "sold_at": "ts", "channel": "event_type"})})


# -- the stored star schema --------------------------------------------------------------------------------

# Channel of each order priority, as the sources code it.
CHANNELS = {"1-URGENT": "Online", "2-HIGH": "Online", "3-MEDIUM": "Retail", "4-NOT SPECIFIED": "Retail", "5-LOW": "Wholesale"}
CHANNEL_SQL = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in CHANNELS.items())
STAR_SQL = f"""
WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS product_key FROM part WHERE p_size <= 45),
s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS supplier_key FROM supplier),
c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer),
h AS (SELECT o_orderpriority AS code, row_number() OVER (ORDER BY o_orderpriority) AS channel_key FROM (SELECT DISTINCT o_orderpriority FROM orders)),
dates AS (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders),
t AS (SELECT d, {DATE_KEY.format('d')} AS date_key FROM dates)
"""


def _supplier_rows(t):
    """Suppliers with the average days from order to shipment and the smallest quantity of their lines."""
    lead = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_suppkey")
            .agg(F.avg(F.datediff("l_shipdate", "o_orderdate")).alias("lead_days"), F.min("l_quantity").alias("min_order_quantity")))
    return (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(lead, F.col("s_suppkey") == F.col("l_suppkey"), "left")
            .select(F.col("s_suppkey").alias("supplier_code"), F.col("s_name").alias("supplier_name"), F.col("n_name").alias("country"),
                    F.round("lead_days", 6).alias("lead_days"), "min_order_quantity"))


def _channel_rows(t):
    channel = F.create_map(*[F.lit(x) for pair in CHANNELS.items() for x in pair])
    return t.orders.select(F.col("o_orderpriority").alias("channel_code")).distinct().withColumn("channel", channel[F.col("channel_code")])


def _customer_rows(t):
    return t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"))


def _star(t, *names):
    """A fresh star schema with the named dimensions, loaded from the given tables."""
    star = StarSchema(t.spark, scratch(t.spark, "star"))
    load = {
        "dim_product": lambda: star.load_dimension("dim_product", t.part.filter("p_size <= 45").select(
            F.col("p_partkey").alias("sku_code"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand")), ["sku_code"], "product_key"),
        "dim_supplier": lambda: star.load_dimension("dim_supplier", _supplier_rows(t), ["supplier_code"], "supplier_key"),
        "dim_location": lambda: star.load_dimension("dim_location", t.supplier.select(
            F.col("s_suppkey").alias("location_id"), F.col("s_name").alias("location_name")), ["location_id"], "location_key"),
        "dim_customer": lambda: star.load_dimension("dim_customer", _customer_rows(t), ["customer_id"], "customer_key"),
        "dim_channel": lambda: star.load_dimension("dim_channel", _channel_rows(t), ["channel_code"], "channel_key"),
        "dim_time": lambda: star.load_calendar(t.orders, "o_orderdate")}
    for name in names:
        load[name]()
    return star


@query("dim_supplier", """
WITH l AS (SELECT l_suppkey, avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS lead_days, min(l_quantity) AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT row_number() OVER (ORDER BY s_suppkey) AS supplier_key, s_suppkey AS supplier_code, s_name AS supplier_name, n_name AS country,
  round(lead_days, 6) AS lead_days, q AS min_order_quantity
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN l ON s_suppkey = l_suppkey""")
def dim_supplier(t):
    return _star(t, "dim_supplier").dimension("dim_supplier")


@query("dim_channel", f"""
SELECT row_number() OVER (ORDER BY o_orderpriority) AS channel_key, o_orderpriority AS channel_code, CASE o_orderpriority {CHANNEL_SQL} END AS channel
FROM (SELECT DISTINCT o_orderpriority FROM orders)""")
def dim_channel(t):
    return _star(t, "dim_channel").dimension("dim_channel")


@query("dimension_reload", """
WITH k AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 WHEN c_mktsegment = 'AUTOMOBILE' THEN 3 ELSE 2 END AS load FROM customer)
SELECT row_number() OVER (ORDER BY load, c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment
FROM customer JOIN k USING (c_custkey)""")
def dimension_reload(t):
    """Three loads of customers, each bringing more: all keep the key of their first load, also those that were away in between."""
    star = StarSchema(t.spark, scratch(t.spark, "star"))
    rows = _customer_rows(t)
    for held in ("segment = 'BUILDING'", "segment NOT IN ('BUILDING', 'AUTOMOBILE')", "true"):
        out = star.load_dimension("dim_customer", rows.filter(held), ["customer_id"], "customer_key")
    return out


LINES_SQL = STAR_SQL + f""", f AS (
SELECT l_orderkey AS order_id, l_linenumber AS line_number, coalesce(product_key, -1) AS product_key, coalesce(supplier_key, -1) AS supplier_key,
  coalesce(customer_key, -1) AS customer_key, coalesce(channel_key, -1) AS channel_key, coalesce(a.date_key, -1) AS date_key,
  coalesce(b.date_key, -1) AS ship_date_key, l_quantity AS ordered_quantity, CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END::DOUBLE AS fulfilled_quantity,
  l_extendedprice AS gross_amount, round(l_extendedprice * l_discount, 4) AS discount_amount, round(l_extendedprice * (1 - l_discount), 4) AS revenue,
  date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lead_days, year(o_orderdate) * 100 + month(o_orderdate) AS order_month
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN p ON l_partkey = p_partkey LEFT JOIN s ON l_suppkey = s_suppkey
LEFT JOIN c ON o_custkey = c_custkey LEFT JOIN h ON o_orderpriority = code LEFT JOIN t a ON a.d = CAST(o_orderdate AS DATE)
LEFT JOIN t b ON b.d = CAST(l_shipdate AS DATE))"""
LINE_DIMENSIONS = ("dim_product", "dim_supplier", "dim_customer", "dim_channel", "dim_time")


@query("fact_order_lines", LINES_SQL + " SELECT * FROM f")
def fact_order_lines(t):
    """Order lines on stored dimensions; products and ship dates that those do not hold get the unknown key."""
    star = _star(t, *LINE_DIMENSIONS)
    out = star.load_fact("fact_order_lines", S.order_lines(star, t.lineitem, t.orders), "order_month")
    out = as_long(out.withColumns({c: F.round(c, 4) for c in ("discount_amount", "revenue")}))
    return out.withColumn("line_number", F.col("line_number").cast("int"))


@query("fact_sales_by_channel", LINES_SQL + f"""
SELECT CASE code {CHANNEL_SQL} END AS channel, order_month, count(*) AS lines, CAST(sum(ordered_quantity) AS DOUBLE) AS quantity, CAST(sum(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM f JOIN h USING (channel_key) GROUP BY ALL""")
def fact_sales_by_channel(t):
    star = _star(t, *LINE_DIMENSIONS)
    star.load_fact("fact_order_lines", S.order_lines(star, t.lineitem, t.orders), "order_month")
    sold = star.fact("fact_order_lines").groupBy("channel_key", "order_month").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("ordered_quantity").alias("quantity"), F.sum(F.col("revenue").cast("decimal(18,4)")).alias("revenue"))
    out = sold.join(star.dimension("dim_channel"), "channel_key").groupBy("channel", "order_month").agg(
        F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"), F.sum("revenue").cast("double").alias("revenue"))
    return as_long(out)


STOCK_SQL = f"""
WITH m AS (SELECT l_partkey AS sku, l_suppkey AS loc, CAST(o_orderdate AS DATE) AS d, 0 AS on_hand, 0 AS reserved, CAST(l_quantity AS BIGINT) AS in_transit FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE), CAST(l_quantity AS BIGINT), CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END,
    -CAST(l_quantity AS BIGINT) FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
daily AS (SELECT sku, loc, d, sum(on_hand) AS a, sum(reserved) AS b, sum(in_transit) AS c FROM m GROUP BY ALL),
snap AS (SELECT sku, loc, d, (sum(a) OVER w)::BIGINT AS on_hand, (sum(b) OVER w)::BIGINT AS reserved, (sum(c) OVER w)::BIGINT AS in_transit FROM daily
  WINDOW w AS (PARTITION BY sku, loc ORDER BY d)),
"""


def _stock_lines(t):
    """Lines with the days they were ordered and shipped on; columns are made narrow before they move."""
    heads = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("ordered"))
    lines = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("sku_code"), F.col("l_suppkey").alias("location_id"), F.to_date("l_shipdate").alias("shipped"),
                              F.col("l_quantity").cast("long").alias("quantity"), (F.col("l_returnflag") == "R").alias("returned"))
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")


def _moves():
    """A line is under way from its order to its shipment, then on hand; returned ones are reserved."""
    quantity, none = F.col("quantity"), F.lit(0).cast("long")
    return F.array(
        F.struct(F.col("ordered").alias("snapshot_date"), none.alias("on_hand"), none.alias("reserved"), quantity.alias("in_transit")),
        F.struct(F.col("shipped").alias("snapshot_date"), quantity.alias("on_hand"),
                 F.when(F.col("returned"), quantity).otherwise(none).alias("reserved"), (-quantity).alias("in_transit")))


def _movements(t):
    return _stock_lines(t).select("sku_code", "location_id", F.inline(_moves()))


MEASURES = ["on_hand", "reserved", "in_transit"]
STOCK_GRAIN = ["sku_code", "location_id", "snapshot_date"]


def _snapshots_of_stock(t, star):
    """Snapshots in sorted ranges. Cost and keys are looked up on items and lines, before they become movements."""
    items = t.part.filter("p_partkey IS NOT NULL").select(F.col("p_partkey").alias("sku_code"), F.col("p_retailprice").alias("unit_cost"))
    require_unique(items, ["sku_code"])
    items = star.with_keys(items, {"product_key": ("dim_product", F.col("sku_code"))})
    lines = star.with_keys(_stock_lines(t).join(items, "sku_code", "left"), {"location_key": ("dim_location", F.col("location_id"))})
    lines = lines.withColumns({"unit_cost": F.col("unit_cost").cast("decimal(10,2)"), "product_key": F.coalesce("product_key", F.lit(UNKNOWN_KEY).cast("long"))})
    out = S.stock_snapshots(lines, ["sku_code", "location_id"], "snapshot_date", MEASURES, ["unit_cost", "product_key", "location_key"], _moves(),
                            -(-4 * t.lineitem.count() // TASK_ROWS))
    return out.withColumn("snapshot_month", S.month_of(F.col("snapshot_date")))


def _inventory(t, *loads):
    star = _star(t, "dim_product", "dim_location", "dim_time")
    rows = S.placed(_snapshots_of_stock(t, star), STOCK_GRAIN, unique=True, ranged=True)
    for load in [rows.filter(held) for held in loads] or [rows]:
        out = star.load_fact("fact_inventory", load, "snapshot_month", STOCK_GRAIN, "inventory_key",
                             lambda df: S.inventory(star, df.withColumn("last_updated", F.col("snapshot_date").cast("timestamp_ntz"))))
    return out


INVENTORY_SQL = KEYS_SQL + ", " + STOCK_SQL.strip().removeprefix("WITH ") + f"""
dates AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)
SELECT row_number() OVER (ORDER BY {{order}}) AS inventory_key, coalesce(product_key, -1) AS product_key, coalesce(location_key, -1) AS location_key,
  CASE WHEN d BETWEEN lo AND hi THEN {DATE_KEY.format('d')} ELSE -1 END AS date_key, sku AS sku_code, loc AS location_id, d AS snapshot_date,
  on_hand AS quantity_on_hand, reserved AS quantity_reserved, in_transit AS quantity_in_transit, on_hand - reserved AS quantity_available,
  CAST(p_retailprice AS DECIMAL(10,2)) AS unit_cost, CAST(on_hand * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(15,2)) AS total_value,
  CAST(d AS TIMESTAMP) AS last_updated, year(d) * 100 + month(d) AS snapshot_month
FROM snap CROSS JOIN dates JOIN part ON sku = part.p_partkey LEFT JOIN p ON sku = p.p_partkey LEFT JOIN s ON loc = s_suppkey"""


@query("fact_inventory_daily", INVENTORY_SQL.format(order="sku, loc, d"))
def fact_inventory_daily(t):
    """SKU by location by day of movement: on hand, reserved, in transit, value, with a key of its own."""
    return as_long(_inventory(t))


@query("fact_inventory_reload", INVENTORY_SQL.format(order="year(d) >= 1999, sku, loc, d"))
def fact_inventory_reload(t):
    """The years up to 1998, then the others, then two of all years once more: no row changes its key."""
    return as_long(_inventory(t, "snapshot_month < 199901", "snapshot_month >= 199901", "snapshot_month BETWEEN 199801 AND 199912"))


@query("inventory_month_end", STOCK_SQL + """
span AS (SELECT max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
ends AS (SELECT last_day(m::DATE) AS month_end FROM span, (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS m)
  WHERE last_day(m::DATE) <= hi),
held AS (SELECT *, lead(d) OVER (PARTITION BY sku, loc ORDER BY d) AS nxt FROM snap)
SELECT loc AS location_id, month_end, count(*) AS items, sum(on_hand)::BIGINT AS on_hand, sum(reserved)::BIGINT AS reserved, sum(in_transit)::BIGINT AS in_transit
FROM held JOIN ends ON month_end >= d AND (nxt IS NULL OR month_end < nxt) GROUP BY ALL""")
def inventory_month_end(t):
    """Closing stock of every location at each month end: added up over items, not over time."""
    until = t.lineitem.agg(F.max(F.to_date("l_shipdate"))).scalar()
    out = S.period_totals(_movements(t), ["sku_code", "location_id"], ["location_id"], "snapshot_date", MEASURES, until)
    return out.select("location_id", "month_end", "items", *MEASURES)


def _daily_by_sku(t):
    return t.lineitem.groupBy(F.col("l_partkey").alias("sku_code"), F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("demand"))


@query("fact_replenishment", """
WITH d AS (SELECT l_partkey AS sku_code, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
w AS (SELECT sku_code, day, sum(q) OVER o AS a, sum(q * q) OVER o AS b FROM d
  WINDOW o AS (PARTITION BY sku_code ORDER BY day RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW)),
s AS (SELECT sku_code, day, a / 90 AS r, sqrt(greatest((b - a * a / 90) / 89, 0)) AS sd FROM w)
SELECT sku_code, day, round(r, 6) AS daily_demand, round(sd, 6) AS demand_std, round(1.6449 * sd * sqrt(14), 6) AS safety_stock,
  round(r * 14 + 1.6449 * sd * sqrt(14), 6) AS reorder_point, round(sqrt(r * 18250), 6) AS eoq FROM s""")
def fact_replenishment(t):
    """SKU by day: reorder point, safety stock and EOQ from the 90 days before."""
    out = S.replenishment_by_day(_daily_by_sku(t), ["sku_code"], "demand", SERVICE_Z[0.95], 14)
    return out.select("sku_code", "day", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


@query("fact_forecast", """
WITH d AS (SELECT l_partkey AS sku_code, date_trunc('week', l_shipdate)::DATE AS week, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
x AS (SELECT * FROM d UNION ALL SELECT sku_code, (SELECT max(week) FROM d) + 7, NULL FROM (SELECT DISTINCT sku_code FROM d)),
w AS (SELECT sku_code, week, q, coalesce(sum(q) OVER o, 0) AS a, coalesce(sum(q * q) OVER o, 0) AS b FROM x
  WINDOW o AS (PARTITION BY sku_code ORDER BY week RANGE BETWEEN INTERVAL 91 DAYS PRECEDING AND INTERVAL 7 DAYS PRECEDING)),
s AS (SELECT sku_code, week, q, a / 13 AS r, sqrt(greatest((b - a * a / 13) / 12, 0)) * sqrt(1 + 1.0 / 13) * 1.6449 AS e FROM w)
SELECT sku_code, week, q AS actual, round(r, 5) AS predicted, round(greatest(r - e, 0), 5) AS lower, round(r + e, 5) AS upper FROM s""")
def fact_forecast(t):
    """SKU by week: demand predicted from the 13 weeks before, with its interval."""
    out = S.forecast_by_week(_daily_by_sku(t), ["sku_code"], "demand", SERVICE_Z[0.95])
    return out.withColumns({c: F.round(c, 5) for c in ("predicted", "lower", "upper")})
