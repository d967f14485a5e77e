"""Schema enforcement, violations, drift, corrupt input."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries.registry import query
from tidelake.quality import schema as S
from tidelake.quality.schema import ColumnSpec, TableSpec
from tidelake.session import scratch

SPEC = TableSpec("stock", (
    ColumnSpec("sku_code", "string", False),
    ColumnSpec("brand", "string", True, None, constraints={"allowed_values": ["Brand#1", "Brand#2", "Brand#3"]}),
    ColumnSpec("size", "bigint", True, None, constraints={"min": 5, "max": 40}),
    ColumnSpec("name", "string", True, None, constraints={"pattern": "^[a-s]"}),
    ColumnSpec("price", "double"),
    ColumnSpec("unit_of_measure", "string", True, "EA"),
), ("sku_code",))

RAW_SQL = """
WITH raw AS (SELECT CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS sku_code, p_brand AS brand,
  CASE WHEN p_partkey % 20 = 0 THEN 'many' ELSE CAST(p_size AS VARCHAR) END AS size, p_name AS name, p_retailprice AS price FROM part)
"""


def raw(t):
    k = F.col("p_partkey")
    return t.part.select(F.when(k % 50 == 0, None).otherwise(k.cast("string")).alias("sku_code"), F.col("p_brand").alias("brand"),
                         F.when(k % 20 == 0, "many").otherwise(F.col("p_size").cast("string")).alias("size"),
                         F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"), F.col("p_type").alias("undeclared"))


def affected(report, df):
    """A schema report with the number of rows it concerns."""
    return report.withColumn("affected_rows", df.agg(F.count(F.lit(1))).scalar())


@query("schema_missing", """
WITH n AS (SELECT count(*) AS n FROM part)
SELECT 'sku_code' AS column_name, 'string' AS data_type, 'error' AS outcome, n AS affected_rows FROM n UNION ALL SELECT 'size', 'bigint', 'filled', n FROM n
UNION ALL SELECT 'name', 'string', 'filled', n FROM n UNION ALL SELECT 'price', 'double', 'filled', n FROM n
UNION ALL SELECT 'unit_of_measure', 'string', 'filled', n FROM n""")
def schema_missing(t):
    df = t.part.withColumnRenamed("p_brand", "brand")
    return affected(S.missing_columns(df, SPEC), df)


@query("schema_defaults", "SELECT p_partkey, p_name AS name, 'EA' AS unit_of_measure, NULL::BIGINT AS size, NULL::DOUBLE AS price, NULL::VARCHAR AS brand FROM part")
def schema_defaults(t):
    return S.with_defaults(t.part.select("p_partkey", F.col("p_name").alias("name")), SPEC)


@query("schema_enforce", RAW_SQL + """
SELECT sku_code, brand, TRY_CAST(size AS BIGINT) AS size, name, price, 'EA' AS unit_of_measure FROM raw""")
def schema_enforce(t):
    return S.enforce(raw(t), SPEC)


@query("schema_violations", RAW_SQL + """, v AS (
SELECT 'sku_code' AS column_name, 'not_null' AS constraint, count(*) FILTER (sku_code IS NULL) AS violation_count FROM raw
UNION ALL SELECT 'brand', 'allowed_values', count(*) FILTER (brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3') OR brand IS NULL) FROM raw
UNION ALL SELECT 'size', 'min', count(*) FILTER (TRY_CAST(size AS BIGINT) < 5) FROM raw
UNION ALL SELECT 'size', 'max', count(*) FILTER (TRY_CAST(size AS BIGINT) > 40) FROM raw
UNION ALL SELECT 'size', 'type', count(*) FILTER (size IS NOT NULL AND TRY_CAST(size AS BIGINT) IS NULL) FROM raw
UNION ALL SELECT 'name', 'pattern', count(*) FILTER (NOT regexp_matches(name, '^[a-s]')) FROM raw)
SELECT * FROM v WHERE violation_count > 0""")
def schema_violations(t):
    return S.violations(raw(t), SPEC)


@query("schema_validate", RAW_SQL + """
SELECT 'sku_code' AS column_name, 'string' AS expected, 'string' AS found, true AS matches, 0::BIGINT AS cast_failures
UNION ALL SELECT 'brand', 'string', 'string', true, 0 UNION ALL SELECT 'size', 'bigint', 'string', false,
  (SELECT count(*) FROM raw WHERE size IS NOT NULL AND TRY_CAST(size AS BIGINT) IS NULL)
UNION ALL SELECT 'name', 'string', 'string', true, 0 UNION ALL SELECT 'price', 'double', 'double', true, 0
UNION ALL SELECT 'unit_of_measure', 'string', NULL, NULL, 0""")
def schema_validate(t):
    """Declared against found types, with the values a cast would lose."""
    df = raw(t)
    lost = S.violations(df, SPEC).filter("constraint = 'type'").select("column_name", F.col("violation_count").alias("n"))
    return S.compare(df, SPEC).join(lost, "column_name", "left").withColumn(
        "cast_failures", F.coalesce("n", F.lit(0).cast("long"))).drop("n")


@query("schema_drift", """
WITH n AS (SELECT count(*) AS n FROM part)
SELECT 'p_brand' AS column_name, 'dropped' AS change, 'string' AS old_type, NULL AS new_type, n AS affected_rows FROM n
UNION ALL SELECT 'p_size', 'retyped', 'int', 'string', n FROM n UNION ALL SELECT 'brand', 'added', NULL, 'string', n FROM n""")
def schema_drift(t):
    df = t.part.withColumnRenamed("p_brand", "brand").withColumn("p_size", F.col("p_size").cast("string"))
    return affected(S.drift(t.part.schema, df), df)


@query("schema_drift_rows", """
WITH n AS (SELECT count(*) AS n FROM part)
SELECT 'p_brand' AS column_name, 'renamed' AS change, 'string' AS old_type, NULL AS new_type, 'brand' AS renamed_to, n AS affected_rows, 0::BIGINT AS lost_values, NULL::DOUBLE AS null_share FROM n
UNION ALL SELECT 'p_type', 'dropped', 'string', NULL, NULL, n, (SELECT count(p_type) FROM part), NULL FROM n
UNION ALL SELECT 'p_size', 'retyped', 'int', 'string', NULL, n, (SELECT count(*) FROM part WHERE p_partkey % 20 = 0), NULL FROM n
UNION ALL SELECT 'origin', 'added', NULL, 'string', NULL, n, 0, (SELECT round(count(*) FILTER (p_partkey % 7 <> 0) / count(*), 6) FROM part) FROM n""")
def schema_drift_rows(t):
    """A delivery with a renamed, a dropped, a retyped and an added column, and what that does to its rows."""
    k = F.col("p_partkey")
    new = t.part.withColumnRenamed("p_brand", "brand").drop("p_type").withColumns({
        "p_size": F.when(k % 20 == 0, "many").otherwise(F.col("p_size").cast("string")), "origin": F.when(k % 7 == 0, F.concat(F.lit("o"), k.cast("string")))})
    return S.drift_rows(t.part, new).withColumn("null_share", F.round("null_share", 6))


@query("schema_registry", """
SELECT 'stock' AS table_name, true AS same_spec, (SELECT count(*) FROM part) AS rows_enforced""")
def schema_registry(t):
    """A schema stored, loaded again and enforced."""
    path = scratch(t.spark, "registry")
    registry = S.SchemaRegistry()
    registry.register(SPEC)
    registry.save(t.spark, path)
    loaded = S.SchemaRegistry.load(t.spark, path).get(SPEC.table)
    rows = S.enforce(raw(t), loaded)
    return rows.agg(F.count(F.lit(1)).alias("rows_enforced")).select(F.lit(SPEC.table).alias("table_name"), F.lit(loaded == SPEC).alias("same_spec"), "rows_enforced")


@query("schema_adapt", "SELECT p_partkey, NULL::VARCHAR AS p_name, p_brand, p_type, CAST(p_size AS INTEGER) AS p_size, p_retailprice, 'new' AS origin FROM part")
def schema_adapt(t):
    changed = t.part.drop("p_name").withColumns({"p_size": F.col("p_size").cast("string"), "origin": F.lit("new")})
    return S.adapt(t.part.schema, changed)


@query("corrupt_records", """
SELECT count(*) FILTER (event_id % 10 <> 0) AS readable, count(*) FILTER (event_id % 10 = 0) AS unreadable FROM events""")
def corrupt_records(t):
    """Every tenth line is cut in half before it lands."""
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    broken = F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 12)).otherwise(line)
    path = scratch(t.spark, "corrupt")
    t.events.select(broken.alias("value")).write.text(path)
    schema = T._parse_datatype_string("event_id bigint, user_id bigint, event_type string")
    good, bad = S.corrupt_records(t.spark, path, schema)
    return good.agg(F.count("event_id").alias("readable")).select(
        "readable", bad.select("file_name").agg(F.count(F.lit(1))).scalar().alias("unreadable"))
