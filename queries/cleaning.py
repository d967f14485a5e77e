"""Projections, scalar functions, null handling, deduplication, outlier removal, the cleaner."""

import datetime as dt

from pyspark.sql import functions as F

from queries.registry import query
from tidelake.functions import text, values
from tidelake.operators import cleaning
from tidelake.operators.cleaning import Cleaner

# Deterministic defects: the same expressions stand in the queries and in the oracle SQL.
GAPS_SQL = """
WITH gaps AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_returnflag END AS flag,
  CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_tax END AS tax FROM lineitem)
"""


def gaps(t):
    def hole(column, factor, value):
        return F.when(F.col(column) % factor == 0, None).otherwise(F.col(value))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
                             hole("l_partkey", 7, "l_quantity").alias("quantity"),
                             hole("l_suppkey", 5, "l_returnflag").alias("flag"),
                             hole("l_orderkey", 3, "l_tax").alias("tax"))


# -- projections -------------------------------------------------------------------------------------------

@query("rename_columns", "SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey FROM nation")
def rename_columns(t):
    return cleaning.rename_columns(t.nation, {"n_nationkey": "nation_id", "n_name": "nation", "absent": "x"})


@query("drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns(t):
    return cleaning.drop_columns(t.customer, ["c_acctbal", "c_mktsegment", "absent"])


@query("reorder_columns", "SELECT p_brand, p_name, p_partkey, p_type, p_size, p_retailprice FROM part")
def reorder_columns(t):
    return cleaning.reorder_columns(t.part, ["p_brand", "p_name"])


@query("add_column", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue, 'EUR' AS currency
FROM lineitem""")
def add_column(t):
    out = cleaning.add_column(t.lineitem, "revenue", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4))
    return cleaning.add_column(out, "currency", "EUR").select("l_orderkey", "l_linenumber", "revenue", "currency")


@query("filter_rows", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_tax <= 0.04")
def filter_rows(t):
    return cleaning.filter_rows(t.lineitem, "l_quantity > 30 AND l_tax <= 0.04").select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("coalesce_columns", GAPS_SQL + """
SELECT l_orderkey, l_linenumber, coalesce(quantity, tax, l_extendedprice) AS measure FROM gaps""")
def coalesce_columns(t):
    return cleaning.coalesce_columns(gaps(t), "measure", ["quantity", "absent", "tax", "l_extendedprice"]).select(
        "l_orderkey", "l_linenumber", "measure")


@query("clip_values", GAPS_SQL + """
SELECT l_orderkey, l_linenumber, CASE WHEN quantity < 10 THEN 10 WHEN quantity > 40 THEN 40 ELSE quantity END
  AS quantity FROM gaps""")
def clip_values(t):
    return cleaning.on_columns(gaps(t), ["quantity"], lambda c: values.clip(c, 10.0, 40.0)).select(
        "l_orderkey", "l_linenumber", "quantity")


@query("map_values", """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' END AS state,
       CASE l_linestatus WHEN 'O' THEN 'open' ELSE l_linestatus END AS status FROM lineitem""")
def map_values(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        values.map_values(F.col("l_returnflag"), {"A": "accepted", "R": "returned"}).alias("state"),
        values.map_values(F.col("l_linestatus"), {"O": "open"}, keep_unmapped=True).alias("status"))


@query("predicate_mix", """
SELECT o_orderkey FROM orders WHERE (o_totalprice BETWEEN 1000 AND 200000 AND o_orderstatus IN ('F', 'O'))
  OR (NOT o_orderpriority = '5-LOW' AND regexp_matches(o_orderpriority, '^[12]-'))""")
def predicate_mix(t):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return cleaning.filter_rows(t.orders, ((price >= 1000) & (price <= 200000) & F.col("o_orderstatus").isin("F", "O"))
                                | (~(priority == "5-LOW") & priority.rlike("^[12]-"))).select("o_orderkey")


# -- scalar functions --------------------------------------------------------------------------------------

@query("standardize_strings", r"""
SELECT c_custkey, regexp_replace(upper(regexp_replace('  ' || lower(c_name) || chr(9) || '! ', '^\s+|\s+$', '', 'g')),
  '[^\w\s-]', '', 'g') AS clean_name FROM customer""")
def standardize_strings(t):
    messy = F.concat(F.lit("  "), F.lower("c_name"), F.lit("\t! "))
    return t.customer.select("c_custkey", text.standardize(messy, remove_special=True).alias("clean_name"))


PHONES = """(CASE WHEN c_custkey % 6 = 0 THEN '555-' || CAST(c_custkey AS VARCHAR)
  ELSE '(0' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || ') 555-01' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') END)"""


@query("clean_phones", f"""
WITH d AS (SELECT c_custkey, regexp_replace({PHONES}, '[^0-9]', '', 'g') AS digits FROM customer)
SELECT c_custkey, CASE WHEN length(digits) >= 10 THEN '+1' || right(digits, 10) END AS phone FROM d""")
def clean_phones(t):
    raw = F.expr(PHONES.replace("VARCHAR", "STRING"))
    return t.customer.select("c_custkey", text.clean_phone(raw).alias("phone"))


EMAILS = """(CASE WHEN c_custkey % 5 = 0 THEN '  user' || CAST(c_custkey AS VARCHAR) || '.Example.COM'
  ELSE ' User' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' END)"""


@query("clean_emails", rf"""
WITH e AS (SELECT c_custkey, trim(lower({EMAILS})) AS email FROM customer)
SELECT c_custkey, CASE WHEN regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}$') THEN email END
  AS email FROM e""")
def clean_emails(t):
    raw = F.expr(EMAILS.replace("VARCHAR", "STRING"))
    return t.customer.select("c_custkey", text.clean_email(raw).alias("email"))


@query("standard_location_code", """
SELECT s_suppkey, regexp_replace(upper(trim(' ' || s_name || '-a.b ')), '[^A-Z0-9]', '', 'g') AS code FROM supplier""")
def standard_location_code(t):
    raw = F.concat(F.lit(" "), F.col("s_name"), F.lit("-a.b "))
    return t.supplier.select("s_suppkey", text.location_code(raw).alias("code"))


@query("parse_dates", """
WITH r AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE strftime(ts, '%d/%m/%Y') END AS raw FROM events)
SELECT event_id, CAST(try_strptime(raw, '%d/%m/%Y') AS DATE) AS day FROM r""")
def parse_dates(t):
    raw = F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.date_format("ts", "dd/MM/yyyy"))
    return t.events.select("event_id", text.parse_date(raw, "%d/%m/%Y").alias("day"))


@query("parse_datetimes", """
WITH r AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw
           FROM events)
SELECT event_id, try_strptime(raw, '%Y-%m-%d %H:%M:%S') AS at FROM r""")
def parse_datetimes(t):
    raw = F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", text.parse_datetime(raw).alias("at"))


@query("to_numeric", r"""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 8 = 0 THEN 'free' ELSE 'USD ' || CAST(p_size AS VARCHAR) || ',000 ' END
           AS raw FROM part)
SELECT p_partkey, TRY_CAST(regexp_replace(raw, '[^\d.-]', '', 'g') AS DOUBLE) AS amount FROM r""")
def to_numeric(t):
    raw = F.when(F.col("p_partkey") % 8 == 0, "free").otherwise(
        F.concat(F.lit("USD "), F.col("p_size").cast("string"), F.lit(",000 ")))
    return t.part.select("p_partkey", text.parse_number(raw).alias("amount"))


@query("cast_schema", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity,
       CAST(l_shipdate AS DATE) AS l_shipdate, CAST(l_discount AS DECIMAL(10,2)) AS l_discount FROM lineitem""")
def cast_schema(t):
    types = {"l_orderkey": "string", "l_quantity": "bigint", "l_shipdate": "date", "l_discount": "decimal(10,2)"}
    return t.lineitem.select(*[F.col(c).cast(d).alias(c) for c, d in types.items()])


@query("age_days", "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS age FROM orders")
def age_days(t):
    return t.orders.select("o_orderkey", values.age_days(F.col("o_orderdate"), dt.date(2001, 12, 31)).cast("long").alias("age"))


@query("bin_numeric", """
SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS size_class
FROM part""")
def bin_numeric(t):
    return t.part.select("p_partkey", values.bin_numeric(F.col("p_size"), [10, 30], ["small", "medium", "large"])
                         .alias("size_class"))


@query("json_path_value", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing.deep') AS missing FROM events""")
def json_path_value(t):
    return t.events.select("event_id", text.json_path(F.col("props"), "k", "int").alias("k"),
                           text.json_path(F.col("props"), "missing.deep").alias("missing"))


@query("dim_time", """
WITH s AS (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d
           FROM orders)
SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS full_date, day(d) AS day_of_month,
  dayofweek(d) + 1 AS day_of_week, weekofyear(d) AS week_of_year, month(d) AS month, quarter(d) AS quarter,
  year(d) AS year, dayofweek(d) IN (0, 6) AS is_weekend FROM s""")
def dim_time(t):
    out = values.calendar(t.orders, "o_orderdate")
    return out.select(*[F.col(c).cast("long").alias(c) if d == "int" else F.col(c) for c, d in out.dtypes])


# -- nulls -------------------------------------------------------------------------------------------------

def _filled(name, sql, rules, columns, **options):
    @query(name, GAPS_SQL + sql)
    def run(t):
        return cleaning.fill_nulls(gaps(t), rules, **options).select("l_orderkey", "l_linenumber", "l_suppkey",
                                                                     "l_extendedprice", *columns)


_filled("fill_constant", """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, coalesce(quantity, 0)
AS quantity, coalesce(flag, 'unknown') AS flag FROM gaps""", {"quantity": "zero", "flag": "unknown"},
        ["quantity", "flag"])

@query("fill_mean", GAPS_SQL + """
SELECT l_orderkey, l_linenumber, l_extendedprice, round(coalesce(quantity, (SELECT avg(quantity) FROM gaps)), 6)
  AS quantity FROM gaps""")
def fill_mean(t):
    return cleaning.fill_nulls(gaps(t), {"quantity": "mean"}).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.round("quantity", 6).alias("quantity"))


_filled("fill_median", """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
coalesce(quantity, (SELECT median(quantity) FROM gaps)) AS quantity,
coalesce(tax, (SELECT median(tax) FROM gaps)) AS tax FROM gaps""", {"quantity": "median", "tax": "median"},
        ["quantity", "tax"])
_filled("fill_mode", """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
coalesce(flag, (SELECT flag FROM gaps WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)) AS flag
FROM gaps""", {"flag": "mode"}, ["flag"])
_filled("fill_callable", """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
coalesce(quantity, -1) * 2 AS quantity FROM gaps""", {"quantity": lambda c: F.coalesce(c, F.lit(-1)) * 2}, ["quantity"])

_ORDER = "PARTITION BY l_suppkey ORDER BY l_shipdate NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_extendedprice NULLS FIRST"
_TIES = ["l_orderkey", "l_linenumber", "l_extendedprice"]
_filled("fill_forward", f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, last_value(quantity IGNORE NULLS)
OVER ({_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS quantity FROM gaps""",
        {"quantity": "forward"}, ["quantity"], keys=["l_suppkey"], order="l_shipdate", tiebreak=_TIES)
_filled("fill_backward", f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, first_value(quantity IGNORE NULLS)
OVER ({_ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS quantity FROM gaps""",
        {"quantity": "backward"}, ["quantity"], keys=["l_suppkey"], order="l_shipdate", tiebreak=_TIES)


@query("fill_interpolate", """
WITH g AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 4 = 1 THEN NULL ELSE value END AS value FROM events),
n AS (SELECT *,
  last_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER b AS t0,
  last_value(value IGNORE NULLS) OVER b AS v0,
  first_value(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER f AS t1,
  first_value(value IGNORE NULLS) OVER f AS v1 FROM g
  WINDOW b AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(value, v0 + (v1 - v0) * (epoch_us(ts) - epoch_us(t0)) / nullif(epoch_us(t1) - epoch_us(t0), 0)), 6)
  AS value FROM n""")
def fill_interpolate(t):
    holes = t.events.withColumn("value", F.when(F.col("event_id") % 4 == 1, None).otherwise(F.col("value")))
    out = cleaning.fill_nulls(holes, {"value": "interpolate"}, ["event_type"], "ts", ["event_id"])
    return out.select("event_id", F.round("value", 6).alias("value"))


@query("drop_nulls", GAPS_SQL + "SELECT l_orderkey, l_linenumber, quantity, flag FROM gaps WHERE quantity IS NOT NULL AND flag IS NOT NULL")
def drop_nulls(t):
    return cleaning.drop_nulls(gaps(t), ["quantity", "flag"]).select("l_orderkey", "l_linenumber", "quantity", "flag")


@query("drop_nulls_threshold", GAPS_SQL + """
SELECT l_orderkey, l_linenumber, quantity, flag, tax FROM gaps
WHERE (quantity IS NULL)::INT + (flag IS NULL)::INT + (tax IS NULL)::INT <= 1""")
def drop_nulls_threshold(t):
    df = gaps(t).select("l_orderkey", "l_linenumber", "quantity", "flag", "tax")
    return cleaning.drop_nulls(df, threshold=0.3)


# -- deduplication -----------------------------------------------------------------------------------------

_KEY = "PARTITION BY l_orderkey, l_linenumber"
_SORT = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query("dedupe_first", f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem
QUALIFY row_number() OVER ({_KEY} ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _SORT.split(', '))}) = 1""")
def dedupe_first(t):
    return cleaning.deduplicate(t.lineitem, ["l_orderkey", "l_linenumber"], "first", ["l_shipdate"]).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query("dedupe_last", f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem
QUALIFY row_number() OVER ({_KEY} ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _SORT.split(', '))}) = 1""")
def dedupe_last(t):
    return cleaning.deduplicate(t.lineitem, ["l_orderkey", "l_linenumber"], "last", ["l_shipdate"]).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query("dedupe_row_hash", """
SELECT DISTINCT l_orderkey, l_linenumber, md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR))
  AS _row_hash FROM lineitem""")
def dedupe_row_hash(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber")
    return cleaning.deduplicate_by_hash(df, ["l_orderkey", "l_linenumber"])


@query("dedupe_fuzzy", r"""
WITH n AS (SELECT regexp_replace(upper(trim(p_name || ' ' || p_brand)), '[^\w\s-]', '', 'g') AS norm,
                  min(p_partkey) AS id FROM part GROUP BY 1)
SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey IN (
  SELECT id FROM n a WHERE NOT EXISTS (
    SELECT 1 FROM n b WHERE b.id < a.id AND abs(length(a.norm) - length(b.norm)) <= 1 AND levenshtein(a.norm, b.norm) <= 1))""")
def dedupe_fuzzy(t):
    named = t.part.select("p_partkey", "p_name", "p_brand", F.concat_ws(" ", "p_name", "p_brand").alias("full_name"))
    return cleaning.deduplicate_fuzzy(named, "p_partkey", "full_name").select("p_partkey", "p_name", "p_brand")


# -- outliers ----------------------------------------------------------------------------------------------

@query("remove_outliers_iqr", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
SELECT event_id, value FROM events, q WHERE value >= a - 1.5 * (b - a) AND value <= b + 1.5 * (b - a)""")
def remove_outliers_iqr(t):
    return cleaning.remove_outliers(t.events, "value").select("event_id", "value")


@query("remove_outliers_zscore", """
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT event_id, value FROM events, s WHERE abs((value - m) / sd) <= 2.5""")
def remove_outliers_zscore(t):
    return cleaning.remove_outliers(t.events, "value", "zscore", 2.5).select("event_id", "value")


@query("flag_outliers", """
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT event_id, value, abs(value - m) > 3.0 * sd AS is_outlier FROM events, s""")
def flag_outliers(t):
    return cleaning.flag_outliers(t.events, "value").select("event_id", "value", "is_outlier")


# -- the cleaner -------------------------------------------------------------------------------------------

CHAIN_SQL = GAPS_SQL + f""",
d AS (SELECT * FROM gaps QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in ('l_shipdate', 'l_partkey', 'l_suppkey', 'l_extendedprice', 'quantity', 'flag', 'tax'))}) = 1)
SELECT l_orderkey AS order_id, l_linenumber, coalesce(quantity, 0) AS quantity, coalesce(upper(flag), 'NONE') AS flag,
       CASE WHEN tax > 0.05 THEN 0.05 ELSE tax END AS tax FROM d WHERE l_extendedprice >= 1000"""


def _cleaner(t):
    return (Cleaner(gaps(t)).deduplicate(["l_orderkey", "l_linenumber"], "first", ["l_shipdate"]).standardize(["flag"])
            .fill_nulls({"quantity": 0.0, "flag": "NONE"}).clip("tax", high=0.05)
            .filter("l_extendedprice >= 1000").rename({"l_orderkey": "order_id"}))


@query("clean_chain", CHAIN_SQL)
def clean_chain(t):
    return _cleaner(t).clean().select("order_id", "l_linenumber", "quantity", "flag", "tax")


@query("cleaning_report", GAPS_SQL + f""",
d AS (SELECT * FROM gaps QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in ('l_shipdate', 'l_partkey', 'l_suppkey', 'l_extendedprice', 'quantity', 'flag', 'tax'))}) = 1)
SELECT 0 AS step, 'duplicates_removed' AS action, 'l_orderkey,l_linenumber' AS columns,
       (SELECT count(*) FROM gaps) - (SELECT count(*) FROM d) AS affected
UNION ALL SELECT 1, 'strings_standardized', 'flag', 1
UNION ALL SELECT 2, 'nulls_filled', 'quantity,flag', (SELECT count(*) FILTER (quantity IS NULL) + count(*) FILTER (flag IS NULL) FROM d)
UNION ALL SELECT 3, 'values_clipped', 'tax', 1
UNION ALL SELECT 4, 'rows_filtered', '', (SELECT count(*) FROM d WHERE l_extendedprice < 1000)
UNION ALL SELECT 5, 'columns_renamed', 'l_orderkey', 1""")
def cleaning_report(t):
    return _cleaner(t).report()


@query("quick_clean", GAPS_SQL + """
SELECT DISTINCT l_orderkey, coalesce(upper(flag), 'NONE') AS flag FROM gaps""")
def quick_clean(t):
    return cleaning.quick_clean(gaps(t).select("l_orderkey", "flag"), ["flag"], {"flag": "NONE"}, ["l_orderkey", "flag"])
