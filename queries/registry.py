"""Collects the registered queries together with their oracle SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelake.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale folder, read lazily: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under a name, with the equivalent SQL where there is one."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark), folder))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
