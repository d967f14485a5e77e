"""Declared table schemas: enforcement, constraint violations, registry, drift."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaError(ValueError):
    """The frame does not fit the declared schema."""


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str
    nullable: bool = True
    default: Any = None
    description: str = ""
    constraints: Mapping[str, Any] = field(default_factory=dict)
    """Any of ``min``, ``max``, ``allowed_values``, ``pattern``."""


@dataclass(frozen=True)
class TableSpec:
    table: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    version: str = "1.0"

    def struct(self) -> T.StructType:
        """Spark schema; defaults and constraints travel in the field metadata, so JSON keeps everything."""
        fields = []
        for c in self.columns:
            metadata = {"description": c.description, "constraints": json.dumps(dict(c.constraints)),
                        "default": json.dumps(c.default)}
            fields.append(T.StructField(c.name, T._parse_datatype_string(c.dtype), c.nullable, metadata))
        return T.StructType(fields)

    def to_json(self) -> str:
        return json.dumps({"table": self.table, "primary_key": list(self.primary_key), "version": self.version,
                           "schema": self.struct().jsonValue()})

    @classmethod
    def from_json(cls, text: str) -> "TableSpec":
        raw = json.loads(text)
        columns = [ColumnSpec(f.name, f.dataType.simpleString(), f.nullable, json.loads(f.metadata["default"]),
                              f.metadata["description"], json.loads(f.metadata["constraints"]))
                   for f in T.StructType.fromJson(raw["schema"])]
        return cls(raw["table"], tuple(columns), tuple(raw["primary_key"]), raw["version"])


# The ready-made schemas.
INVENTORY = TableSpec("inventory", (
    ColumnSpec("sku_code", "string", False),
    ColumnSpec("location_id", "string", False),
    ColumnSpec("quantity_on_hand", "bigint", True, 0, constraints={"min": 0}),
    ColumnSpec("quantity_reserved", "bigint", True, 0, constraints={"min": 0}),
    ColumnSpec("quantity_available", "bigint", True, 0),
    ColumnSpec("unit_cost", "double", True, None, constraints={"min": 0}),
    ColumnSpec("last_count_date", "date"),
    ColumnSpec("last_movement_date", "date"),
), ("sku_code", "location_id"))

PRODUCT = TableSpec("product", (
    ColumnSpec("sku_code", "string", False),
    ColumnSpec("product_name", "string"),
    ColumnSpec("category_l1", "string"),
    ColumnSpec("category_l2", "string"),
    ColumnSpec("category_l3", "string"),
    ColumnSpec("brand", "string"),
    ColumnSpec("supplier_code", "string"),
    ColumnSpec("unit_of_measure", "string", True, "EA"),
    ColumnSpec("abc_class", "string", constraints={"allowed_values": ["A", "B", "C"]}),
    ColumnSpec("xyz_class", "string", constraints={"allowed_values": ["X", "Y", "Z"]}),
    ColumnSpec("is_active", "boolean", True, True),
), ("sku_code",))


def missing_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns the frame lacks; required ones are errors."""
    rows = [(c.name, c.dtype, "error" if not c.nullable and c.default is None else "filled")
            for c in spec.columns if c.name not in df.columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, outcome string")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {missing}")


def with_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add absent columns: default, else NULL when nullable, else left out."""
    absent = [c for c in spec.columns if c.name not in df.columns and (c.default is not None or c.nullable)]
    return df.withColumns({c.name: F.lit(c.default).cast(c.dtype) for c in absent}) if absent else df


def enforce(df: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """Add defaults, cast, order and drop undeclared columns.

    Strict mode raises on an absent required column and on a value that cannot be cast (ANSI cast at run time);
    lenient mode turns such values into NULL, which :func:`violations` counts.
    """
    if strict:
        require_columns(df, [c.name for c in spec.columns if not c.nullable and c.default is None])
    full = with_defaults(df, spec)
    present = [c for c in spec.columns if c.name in full.columns]
    return full.select(*[(F.col(c.name).cast(c.dtype) if strict else F.col(c.name).try_cast(c.dtype)).alias(c.name)
                         for c in present])


def _checks(c: ColumnSpec) -> dict[str, Column]:
    """Constraint masks of one column; NULL breaks ``allowed_values`` and is ignored by the others."""
    col, found = F.col(c.name), {}
    if not c.nullable:
        found["not_null"] = col.isNull()
    if "min" in c.constraints:
        found["min"] = F.coalesce(col < F.lit(c.constraints["min"]), F.lit(False))
    if "max" in c.constraints:
        found["max"] = F.coalesce(col > F.lit(c.constraints["max"]), F.lit(False))
    if "allowed_values" in c.constraints:
        values = c.constraints["allowed_values"]
        inside = F.coalesce(col.isin([v for v in values if v is not None]), F.lit(False))
        found["allowed_values"] = ~(inside | col.isNull()) if None in values else ~inside
    if "pattern" in c.constraints:
        found["pattern"] = F.coalesce(~col.rlike(c.constraints["pattern"]), F.lit(False))
    return found


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``column_name, constraint, violation_count`` for every broken constraint and failed cast, in one pass.

    ``df`` is the frame *before* enforcement: a cast failure is a value that is not NULL but casts to NULL.
    """
    masks: list[tuple[str, str, Column]] = []
    typed = enforce(df, spec)
    declared = {c.name: c for c in spec.columns}
    originals = df.select(*[F.col(c).alias(f"__raw_{c}") for c in df.columns if c in declared],
                          *[F.col(c) for c in with_defaults(df, spec).columns if c in df.columns and c in declared])
    frame = with_defaults(originals, spec)
    frame = frame.withColumns({c.name: F.col(c.name).try_cast(c.dtype) for c in spec.columns if c.name in typed.columns})
    for c in spec.columns:
        if c.name not in typed.columns:
            continue
        for constraint, mask in _checks(c).items():
            masks.append((c.name, constraint, mask))
        if c.name in df.columns:
            masks.append((c.name, "type", F.col(f"__raw_{c.name}").isNotNull() & F.col(c.name).isNull()))
    one = frame.agg(*[F.count(F.when(m, F.lit(1))).alias(f"v{i}") for i, (_, _, m) in enumerate(masks)])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("constraint"),
                              F.col(f"v{i}").alias("violation_count")) for i, (n, k, _) in enumerate(masks)])
    return one.select(F.inline(rows)).filter("violation_count > 0")


def compare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per declared column: expected and found type, and whether they agree (NULL when absent)."""
    found = dict(df.dtypes)
    rows = []
    for c in spec.columns:
        expected, actual = T._parse_datatype_string(c.dtype).simpleString(), found.get(c.name)
        rows.append((c.name, expected, actual, None if actual is None else actual == expected))
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, found string, matches boolean")


def validate(df: DataFrame, spec: TableSpec) -> bool:
    found = dict(df.dtypes)
    return all(found.get(c.name) == T._parse_datatype_string(c.dtype).simpleString() for c in spec.columns)


def drift(old: T.StructType, df: DataFrame) -> DataFrame:
    """Columns added, dropped or retyped against an earlier schema."""
    before, after = {f.name: f.dataType.simpleString() for f in old}, dict(df.dtypes)
    rows = []
    for name in list(before) + [n for n in after if n not in before]:
        if name not in after:
            rows.append((name, "dropped", before[name], None))
        elif name not in before:
            rows.append((name, "added", None, after[name]))
        elif before[name] != after[name]:
            rows.append((name, "retyped", before[name], after[name]))
    return df.sparkSession.createDataFrame(rows, "column_name string, change string, old_type string, new_type string")


def adapt(old: T.StructType, df: DataFrame, halt: bool = False) -> DataFrame:
    """Halt on drift, or shape the frame to the old schema plus its new columns."""
    before = {f.name: f.dataType for f in old}
    changed = [n for n, t in before.items() if n not in df.columns or df.schema[n].dataType != t]
    changed += [n for n in df.columns if n not in before]
    if changed and halt:
        raise SchemaError(f"schema drift in {sorted(changed)}")
    kept = [(F.col(n).try_cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in before.items()]
    return df.select(*kept, *[c for c in df.columns if c not in before])


class SchemaRegistry:
    """Specs by table name, stored as one JSON file per table."""

    def __init__(self) -> None:
        self._specs: dict[str, TableSpec] = {}

    def register(self, spec: TableSpec) -> None:
        self._specs[spec.table] = spec

    def get(self, table: str) -> TableSpec:
        if table not in self._specs:
            raise SchemaError(f"no schema for {table}")
        return self._specs[table]

    def names(self) -> list[str]:
        return sorted(self._specs)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(name, spec.to_json()) for name, spec in self._specs.items()]
        spark.createDataFrame(rows, "table string, spec string").write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SchemaRegistry":
        registry = cls()
        for row in spark.read.schema("table string, spec string").json(path).collect():
            registry.register(TableSpec.from_json(row["spec"]))
        return registry


def corrupt_records(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                    **options: str) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and unreadable lines with the file they stand in.

    Lines are read as text and parsed with a corrupt-record column, so both sides may be queried freely.
    """
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", **options}
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    if fmt == "json":
        parsed = F.from_json("value", full, settings)
    elif fmt == "csv":
        parsed = F.from_csv(F.col("value"), full.toDDL(), settings)
    else:
        raise ValueError(f"no line parser for {fmt}")
    rows = lines.select("file_name", "value", parsed.alias("r"))
    corrupt = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    return (rows.filter(~corrupt).select(*[F.col(f"r.{n}").alias(n) for n in schema.names]),
            rows.filter(corrupt).select(F.col("value").alias("_corrupt_record"), "file_name"))


def unreadable_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Listed Parquet files that cannot be read, or hold no rows: ``path, file_name, size_bytes, error``.

    Each file is judged by its own footer and told apart by its full path.
    """
    from tidelake.sources.files import parquet_footers
    footers = parquet_footers(spark, path, pattern).filter(~F.col("readable") | (F.col("row_count") == 0))
    return footers.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "size_bytes",
                          F.coalesce("error", F.lit("no rows")).alias("error"))


#: Share of common values from which a column counts as renamed.
RENAMED = 0.8
DRIFT = ("column_name string, change string, old_type string, new_type string, renamed_to string, affected_rows bigint, "
         "lost_values bigint, null_share double")


def drift_rows(old: DataFrame, new: DataFrame, renamed: float = RENAMED) -> DataFrame:
    """What a changed schema does to the data: ``DRIFT`` per changed column.

    A dropped and an added column of one type whose values overlap (distinct-value sketches: union against both) is a rename. A
    dropped column loses its values; a retyped one those that cannot be cast back; an added one shows how much of it is
    NULL. One aggregate reads the changed columns of each table, whatever their number.
    """
    before, after = dict(old.dtypes), dict(new.dtypes)
    dropped, added = [c for c in before if c not in after], [c for c in after if c not in before]
    retyped = [c for c in before if c in after and before[c] != after[c]]
    col = lambda c: F.col(f"`{c}`")
    sketch = lambda c: F.hll_sketch_agg(col(c).cast("string"), 14)
    was = old.agg(F.count(F.lit(1)).alias("n_old"), *[F.count(col(c)).alias(f"held_{i}") for i, c in enumerate(dropped)],
                  *[sketch(c).alias(f"old_{i}") for i, c in enumerate(dropped)])
    lost = [F.count_if(col(c).isNotNull() & col(c).try_cast(old.schema[c].dataType).isNull()).alias(f"lost_{i}") for i, c in enumerate(retyped)]
    now = new.agg(F.count(F.lit(1)).alias("n_new"), *lost, *[F.count(col(c)).alias(f"filled_{i}") for i, c in enumerate(added)],
                  *[sketch(c).alias(f"new_{i}") for i, c in enumerate(added)])
    cells, none = [], F.lit(None)

    def row(name, change, old_type, new_type, to, rows, values, share):
        cells.append(F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(("column_name", "change", "old_type", "new_type"), (name, change, old_type, new_type))],
                              to.cast("string").alias("renamed_to"), rows.alias("affected_rows"), values.cast("bigint").alias("lost_values"),
                              share.cast("double").alias("null_share")))

    taken: Column = F.array().cast("array<string>")
    shares, one = [], was.crossJoin(now)  # one row each
    for i, c in enumerate(dropped):
        pairs = []
        for j, a in enumerate(added):
            if before[c] == after[a]:
                size = [F.hll_sketch_estimate(F.coalesce(x, F.hll_union(x, x))) for x in (F.col(f"old_{i}"), F.col(f"new_{j}"))]
                union = F.hll_sketch_estimate(F.hll_union(F.col(f"old_{i}"), F.col(f"new_{j}")))
                pairs.append(F.struct(((size[0] + size[1] - union) / F.nullif(union, F.lit(0))).cast("double").alias("share"), F.lit(a).alias("name")))
        best = F.array_max(F.array(*pairs)) if pairs else F.lit(None).cast("struct<share:double,name:string>")
        shares.append(F.when(best["share"] >= renamed, best["name"]).alias(f"to_{i}"))
    one = one.select("*", *shares)
    for i, c in enumerate(dropped):
        to = F.col(f"to_{i}")
        taken = F.concat(taken, F.array_compact(F.array(to)))
        row(c, "dropped", before[c], None, to, F.col("n_old"), F.when(to.isNotNull(), 0).otherwise(F.col(f"held_{i}")), none)
    for i, c in enumerate(retyped):
        row(c, "retyped", before[c], after[c], none, F.col("n_new"), F.col(f"lost_{i}"), none)
    for i, c in enumerate(added):
        share = F.try_divide(F.col("n_new") - F.col(f"filled_{i}"), F.col("n_new"))
        row(c, "added", None, after[c], none, F.col("n_new"), F.lit(0), share)
    if not cells:
        return new.sparkSession.createDataFrame([], DRIFT)
    flat = one.withColumn("__taken", taken).select("__taken", F.inline(F.array(*cells)))
    # A rename is one row, under its old name.
    shown = flat.filter(~((F.col("change") == "added") & F.array_contains("__taken", F.col("column_name"))))
    return shown.select("column_name", F.when(F.col("renamed_to").isNotNull(), "renamed").otherwise(F.col("change")).alias("change"), "old_type", "new_type",
                        "renamed_to", "affected_rows", "lost_values", "null_share")
