"""Joins, set operations and group summaries used by the table pipelines.

No join carries a broadcast hint: Catalyst broadcasts a side when its statistics, or at run time its measured
shuffle size, stay below ``spark.sql.autoBroadcastJoinThreshold``, and splits skewed partitions otherwise.
Foreign keys are counted per key before they are compared with a reference, so a hot key travels as one row.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def orphan_rows(df: DataFrame, column: str, reference: DataFrame, ref_column: str) -> DataFrame:
    """Rows whose non-null key is missing from the reference."""
    known = reference.select(F.col(ref_column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(*df.columns)


def orphan_counts(df: DataFrame, column: str, reference: DataFrame, ref_column: str) -> DataFrame:
    """``total``, ``orphans`` (rows) and ``orphan_keys`` for one foreign key, as one row."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = reference.select(F.col(ref_column).alias(column)).distinct().withColumn("__known", F.lit(True))
    missing = F.col("__known").isNull() & F.col(column).isNotNull()
    zero = F.lit(0).cast("long")
    return counts.join(known, column, "left").agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), zero).alias("orphans"),
        F.count(F.when(missing, F.lit(1))).alias("orphan_keys"))


def fk_orphan_report(df: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per foreign key; any orphan makes the key fail."""
    parts = [orphan_counts(df, fk, ref, ref_col).select(F.lit(fk).alias("foreign_key"), "*",
                                                        (F.col("orphans") == 0).alias("passed"))
             for fk, (ref, ref_col) in references.items()]
    return reduce(DataFrame.unionByName, parts)


def missing_expected(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen before and absent now."""
    return distinct_keys(previous, keys).join(distinct_keys(current, keys), list(keys), "left_anti")


def conformed_mismatch(left: DataFrame, right: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys whose attributes disagree between two tables that share a dimension, or exist on one side only."""
    a = left.select(key, F.struct(*attributes).alias("left_values"), F.lit(True).alias("in_left"))
    b = right.select(key, F.struct(*attributes).alias("right_values"), F.lit(True).alias("in_right"))
    status = (F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only")
              .when(~F.col("left_values").eqNullSafe(F.col("right_values")), "different"))
    return (a.join(b, key, "full_outer").select(key, status.alias("status")).filter("status IS NOT NULL"))


def enrich(df: DataFrame, reference: DataFrame, on: str, attributes: Sequence[str]) -> DataFrame:
    """Left join reference attributes; of several reference rows of a key the smallest is taken, so no rows multiply."""
    unique = reference.groupBy(on).agg(F.min(F.struct(*attributes)).alias("__found"))
    return df.join(unique, on, "left").select(*df.columns, *[F.col(f"__found.{a}").alias(a) for a in attributes])


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def except_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Distinct values outside the allowed list; NULL counts as a value."""
    c = F.col(column)
    inside = F.coalesce(c.isin([a for a in allowed if a is not None]), F.lit(False))
    if None in allowed:
        inside = inside | c.isNull()
    return df.filter(~inside).select(column).distinct()


def sample_values(df: DataFrame, column: str, condition: Column, n: int = 5) -> DataFrame:
    """The ``n`` lowest distinct offending values; each task keeps only ``n``."""
    return df.filter(condition).select(column).distinct().orderBy(F.col(column).asc()).limit(n)


def group_metrics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias("total"), F.avg(value).alias("average"),
                                 F.count(F.lit(1)).alias("records"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls, completeness. One aggregate over all columns."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("n") - F.col(f"c{i}")).alias("null_count"))
                     for i, c in enumerate(df.columns)])
    flat = stats.select("n", F.inline(rows))
    return flat.select("column_name", F.col("n").alias("total_rows"), "null_count",
                       F.coalesce(F.try_divide(F.col("n") - F.col("null_count"), F.col("n")), F.lit(0.0))
                       .alias("completeness"))
