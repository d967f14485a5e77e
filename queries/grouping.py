"""Joins, aggregates, ranking, sorting and set operations."""

from pyspark.sql import functions as F

from queries.cleaning import GAPS_SQL, gaps
from queries.registry import query
from tidelake.functions.text import standardize
from tidelake.operators import relate, series
from tidelake.operators.cleaning import deduplicate, fill_nulls
from tidelake.quality.anomalies import column_profile as profile

REVENUE = "l_extendedprice * (1 - l_discount)"


# -- the flagship: scan, clean, dedupe, join, aggregate, top-k ---------------------------------------------

@query("stock_value_top", """
WITH d AS (SELECT l_partkey, coalesce(CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END, 0) AS quantity
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_partkey DESC NULLS LAST, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END DESC NULLS LAST) = 1),
p AS (SELECT p_partkey, p_type, regexp_replace(upper(trim(p_brand)), '[^\\w\\s-]', '', 'g') AS brand, p_retailprice FROM part)
SELECT p_type, brand, count(*) AS line_count, CAST(sum(quantity) AS DOUBLE) AS quantity,
       round(sum(quantity * p_retailprice), 2) AS stock_value
FROM d JOIN p ON l_partkey = p_partkey GROUP BY p_type, brand ORDER BY stock_value DESC, p_type, brand LIMIT 100""")
def stock_value_top(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey",
                              F.when(F.col("l_partkey") % 7 == 0, None).otherwise(F.col("l_quantity")).alias("quantity"))
    clean = fill_nulls(deduplicate(lines, ["l_orderkey", "l_linenumber"], "last", ["l_shipdate"]), {"quantity": "zero"})
    parts = t.part.select("p_partkey", "p_type", standardize(F.col("p_brand"), remove_special=True).alias("brand"),
                          "p_retailprice")
    # Lines are summed per part before the join: the shuffle carries parts, not lines.
    per_part = clean.groupBy("l_partkey").agg(F.sum("quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    joined = per_part.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return (joined.groupBy("p_type", "brand")
            .agg(F.sum("n").alias("line_count"), F.sum("q").alias("quantity"),
                 F.round(F.sum(F.col("q") * F.col("p_retailprice")), 2).alias("stock_value"))
            .orderBy(F.desc("stock_value"), "p_type", "brand").limit(100))


# -- joins -------------------------------------------------------------------------------------------------

@query("orphan_rows", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)""")
def orphan_rows(t):
    known = t.part.filter("p_size <= 45")
    return relate.orphan_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", known, "p_partkey")


@query("star_join_agg", """
SELECT p_type, CAST(sum(l_quantity) AS DOUBLE) AS total_quantity, count(*) AS sales FROM lineitem
JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def star_join_agg(t):
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type")
            .agg(F.sum("l_quantity").alias("total_quantity"), F.count(F.lit(1)).alias("sales")))


@query("complex_three_joins", """
SELECT r_name, p_type, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
  CAST(sum(l_quantity) AS DOUBLE) AS quantity, round(avg(l_discount), 6) AS avg_discount,
  max(l_extendedprice) AS top_price, count(*) AS sales
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, p_type""")
def complex_three_joins(t):
    places = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
              .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name"))
    return (t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .join(places, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("r_name", "p_type")
            .agg(F.round(F.sum(F.expr(REVENUE)), 4).alias("revenue"), F.sum("l_quantity").alias("quantity"),
                 F.round(F.avg("l_discount"), 6).alias("avg_discount"), F.max("l_extendedprice").alias("top_price"),
                 F.count(F.lit(1)).alias("sales")))


@query("fk_orphan_report", """
WITH o AS (SELECT
  count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)) AS p,
  count(DISTINCT l_partkey) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)) AS pk,
  count(*) FILTER (l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) AS s,
  count(DISTINCT l_suppkey) FILTER (l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) AS sk, count(*) AS n FROM lineitem)
SELECT 'l_partkey' AS foreign_key, n AS total, p AS orphans, pk AS orphan_keys, p = 0 AS passed FROM o
UNION ALL SELECT 'l_suppkey', n, s, sk, s = 0 FROM o""")
def fk_orphan_report(t):
    return relate.fk_orphan_report(t.lineitem, {"l_partkey": (t.part.filter("p_size <= 45"), "p_partkey"),
                                                "l_suppkey": (t.supplier, "s_suppkey")})


@query("missing_expected", """
SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')""")
def missing_expected(t):
    split = F.lit("2000-01-01").cast("timestamp_ntz")
    return relate.missing_expected(t.orders.filter(F.col("o_orderdate") < split),
                                   t.orders.filter(F.col("o_orderdate") >= split), ["o_custkey"])


@query("conformed_mismatch", """
WITH a AS (SELECT p_partkey, p_brand, p_type FROM part WHERE p_size <= 48),
b AS (SELECT p_partkey, CASE WHEN p_retailprice > 1500 THEN 'OTHER' ELSE p_brand END AS p_brand, p_type FROM part WHERE p_size >= 3)
SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN b.p_partkey IS NULL THEN 'left_only'
  WHEN a.p_partkey IS NULL THEN 'right_only' ELSE 'different' END AS status
FROM a FULL JOIN b ON a.p_partkey = b.p_partkey
WHERE a.p_partkey IS NULL OR b.p_partkey IS NULL OR a.p_brand <> b.p_brand OR a.p_type <> b.p_type""")
def conformed_mismatch(t):
    left = t.part.filter("p_size <= 48")
    right = t.part.filter("p_size >= 3").withColumn(
        "p_brand", F.when(F.col("p_retailprice") > 1500, "OTHER").otherwise(F.col("p_brand")))
    return relate.conformed_mismatch(left, right, "p_partkey", ["p_brand", "p_type"])


@query("enrich_reference", """
SELECT o_orderkey, o_custkey, c_mktsegment, c_nationkey FROM orders
LEFT JOIN (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""")
def enrich_reference(t):
    reference = t.customer.filter("c_acctbal >= 0").withColumnRenamed("c_custkey", "o_custkey")
    return relate.enrich(t.orders.select("o_orderkey", "o_custkey"), reference, "o_custkey", ["c_mktsegment", "c_nationkey"])


# -- aggregates --------------------------------------------------------------------------------------------

@query("group_three_cols", """
SELECT l_returnflag, l_linestatus, l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
  round(sum(l_extendedprice), 2) AS revenue, round(sum(l_tax), 2) AS tax, round(avg(l_discount), 6) AS avg_discount,
  count(*) AS units FROM lineitem GROUP BY 1, 2, 3""")
def group_three_cols(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(
        F.sum("l_quantity").alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.round(F.sum("l_tax"), 2).alias("tax"), F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.count(F.lit(1)).alias("units"))


@query("qty_by_location", """
SELECT l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' GROUP BY l_suppkey""")
def qty_by_location(t):
    day = F.col("l_shipdate")
    return (t.lineitem.filter((day >= F.lit("1998-01-01").cast("timestamp_ntz")) &
                              (day < F.lit("1999-01-01").cast("timestamp_ntz")))
            .groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity")))


@query("group_metrics", """
SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS average,
  count(*) AS records FROM orders GROUP BY 1, 2""")
def group_metrics(t):
    out = relate.group_metrics(t.orders, ["o_orderstatus", "o_orderpriority"], "o_totalprice")
    return out.withColumns({"total": F.round("total", 2), "average": F.round("average", 4)})


@query("daily_category_sales", """
SELECT CAST(l_shipdate AS DATE) AS day, p_type, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
  count(*) AS sales FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 ORDER BY 1, 2""")
def daily_category_sales(t):
    sales = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return (sales.groupBy(F.to_date("l_shipdate").alias("day"), "p_type")
            .agg(F.round(F.sum(F.expr(REVENUE)), 4).alias("revenue"), F.count(F.lit(1)).alias("sales"))
            .orderBy("day", "p_type"))


@query("group_having", """
SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
HAVING count(*) >= 10 AND sum(o_totalprice) > 1000000""")
def group_having(t):
    return (t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("s"))
            .filter("orders >= 10 AND s > 1000000").select("o_custkey", "orders", F.round("s", 2).alias("total")))


@query("column_profile", """
SELECT 'value' AS column_name, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(median(value), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max, round(sum(value), 2) AS total,
  round((SELECT median(abs(value - (SELECT median(value) FROM events))) FROM events), 6) AS mad FROM events
UNION ALL
SELECT 'user_id', count(user_id), round(avg(user_id), 6), round(stddev_samp(user_id), 6), min(user_id),
  round(quantile_cont(user_id, 0.25), 6), round(median(user_id), 6), round(quantile_cont(user_id, 0.75), 6), max(user_id),
  sum(user_id), round((SELECT median(abs(user_id - (SELECT median(user_id) FROM events))) FROM events), 6) FROM events""")
def column_profile(t):
    out = profile(t.events, ["value", "user_id"])
    digits = {"total": 2}
    return out.select("column_name", "n", *[F.round(c, digits.get(c, 6)).alias(c)
                                            for c in out.columns if c not in ("column_name", "n")])


@query("null_profile", GAPS_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, "
    f"round(count({c}) / count(*), 6) AS completeness FROM gaps" for c in ("quantity", "flag", "tax")))
def null_profile(t):
    return relate.null_profile(gaps(t).select("quantity", "flag", "tax")).withColumn(
        "completeness", F.round("completeness", 6))


@query("distinct_tuples", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_tuples(t):
    return relate.distinct_keys(t.lineitem, ["l_returnflag", "l_linestatus", "l_suppkey"])


@query("distinct_counts", """
SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS line_keys FROM lineitem""")
def distinct_counts(t):
    """Each count is its own two-step aggregate; one plan with several distinct counts would multiply the rows."""
    def distinct(*keys):
        return t.lineitem.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n"))
    return distinct("l_partkey").select(F.col("n").alias("parts"), distinct("l_suppkey").scalar().alias("suppliers"),
                                        distinct("l_orderkey", "l_linenumber").scalar().alias("line_keys"))


@query("tier_precision", """
SELECT event_type AS tier, count(*) FILTER (value > 50 AND user_id < 75) AS true_positives,
  count(*) FILTER (value > 50 AND user_id >= 75) AS false_positives,
  round(count(*) FILTER (value > 50 AND user_id < 75) / nullif(count(*) FILTER (value > 50), 0), 6) AS precision
FROM events GROUP BY event_type""")
def tier_precision(t):
    flagged, real = F.col("value") > 50, F.col("user_id") < 75
    out = t.events.groupBy(F.col("event_type").alias("tier")).agg(
        F.count(F.when(flagged & real, 1)).alias("true_positives"),
        F.count(F.when(flagged & ~real, 1)).alias("false_positives"))
    both = F.col("true_positives") + F.col("false_positives")
    return out.withColumn("precision", F.round(F.try_divide(F.col("true_positives"), both), 6))


# -- ranking, sorting, sets --------------------------------------------------------------------------------

@query("product_rank", """
WITH s AS (SELECT p_type, l_partkey, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_type, l_partkey, CAST(q AS DOUBLE) AS quantity, rank() OVER (PARTITION BY p_type ORDER BY q DESC) AS position FROM s""")
def product_rank(t):
    sold = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    typed = sold.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return series.ranked(typed.select("p_type", "l_partkey", "quantity"), ["p_type"], "quantity")


@query("sort_nulls_first", GAPS_SQL + """
SELECT l_orderkey, l_linenumber, quantity, flag FROM gaps ORDER BY flag NULLS FIRST, quantity NULLS FIRST, l_orderkey""")
def sort_nulls_first(t):
    return gaps(t).select("l_orderkey", "l_linenumber", "quantity", "flag").orderBy("flag", "quantity", "l_orderkey")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_k(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("sample_invalid", "SELECT DISTINCT c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_acctbal LIMIT 5")
def sample_invalid(t):
    return relate.sample_values(t.customer, "c_acctbal", F.col("c_acctbal") < 0, 5)


@query("union_all", """
SELECT n_name AS name, n_regionkey AS region_id FROM nation UNION ALL SELECT s_name, NULL FROM supplier""")
def union_all(t):
    return relate.union_all(t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_id")),
                            t.supplier.select(F.col("s_name").alias("name")))


@query("except_values", GAPS_SQL + "SELECT DISTINCT flag FROM gaps WHERE flag IS NULL OR flag NOT IN ('A', 'N')")
def except_values(t):
    return relate.except_values(gaps(t), "flag", ["A", "N"])
