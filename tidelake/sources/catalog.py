"""SQL over registered tables: frames, Parquet folders, and a whole Gold layer."""

from __future__ import annotations

from functools import reduce
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.sinks.tables import export, write_table
from tidelake.sources.files import list_directories, path_exists

# Where Gold keeps its tables, in lookup order.
GOLD_FOLDERS = ("facts", "dimensions")


class Lakehouse:
    """Named tables on one session; queries stay lazy DataFrames."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[str, str | None] = {}

    def register_frame(self, name: str, df: DataFrame) -> "Lakehouse":
        df.createOrReplaceTempView(name)
        self.tables[name] = None
        return self

    def register_parquet(self, name: str, path: str) -> "Lakehouse":
        """View over a Parquet file or folder; Hive partition columns are part of it."""
        self.spark.read.parquet(path).createOrReplaceTempView(name)
        self.tables[name] = path
        return self

    def load_gold(self, gold_path: str, tables: Mapping[str, str] | None = None) -> list[str]:
        """Register the given ``{name: relative path}``, or every folder below ``facts`` and ``dimensions``."""
        found = dict(tables or {})
        if tables is None:
            for kind in GOLD_FOLDERS:
                for name in list_directories(self.spark, f"{gold_path}/{kind}"):
                    found[name] = f"{kind}/{name}"
        for name, relative in found.items():
            self.register_parquet(name, f"{gold_path}/{relative}")
        return sorted(found)

    def query(self, sql: str, params: Mapping[str, Any] | None = None) -> DataFrame:
        """Any SQL with ``:name`` parameters."""
        return self.spark.sql(sql, args=dict(params or {}))

    def execute(self, sql: str) -> None:
        self.spark.sql(sql)

    def list_tables(self) -> list[str]:
        return sorted(self.tables)

    def table_info(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE {name}")

    def table_stats(self) -> DataFrame:
        """Name, row count and column count of every registered table."""
        parts = []
        for name in self.list_tables():
            df = self.spark.table(name)
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")))
        return reduce(DataFrame.unionByName, parts)

    def aggregate_table(self, name: str, sql: str, materialise_at: str | None = None) -> DataFrame:
        """A summary as a view, or as Parquet files behind a view."""
        if materialise_at is None:
            self.spark.sql(sql).createOrReplaceTempView(name)
            self.tables[name] = None
        else:
            write_table(self.spark.sql(sql), materialise_at)
            self.register_parquet(name, materialise_at)
        return self.spark.table(name)

    def export_query(self, sql: str, path: str, fmt: str = "parquet", codec: str = "snappy",
                     header: bool = True) -> None:
        export(self.query(sql), path, fmt, codec, header)


def query_lakehouse(spark: SparkSession, gold_path: str, sql: str, tables: Sequence[str]) -> DataFrame:
    """One query over Gold tables, each looked up below ``facts`` and then ``dimensions``."""
    lake = Lakehouse(spark)
    for name in tables:
        for kind in GOLD_FOLDERS:
            if path_exists(spark, f"{gold_path}/{kind}/{name}"):
                lake.register_parquet(name, f"{gold_path}/{kind}/{name}")
                break
        else:
            raise FileNotFoundError(f"no Gold table {name} below {gold_path}")
    return lake.query(sql)


def create_analytics_db(spark: SparkSession, gold_path: str, database: str, location: str) -> DataFrame:
    """Persist Gold as a catalog database of external tables that other sessions can share.

    The tables point at the Gold files themselves; no data is copied.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    rows = []
    for kind in GOLD_FOLDERS:
        for name in list_directories(spark, f"{gold_path}/{kind}"):
            path = f"{gold_path}/{kind}/{name}"
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
            spark.catalog.recoverPartitions(f"{database}.{name}") if list_directories(spark, path) else None
            rows.append(spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "row_count"))
    return reduce(DataFrame.unionByName, rows)
