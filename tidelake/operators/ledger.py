"""Deferred drops: rows that a step drops stay in the frame as *ghosts*, so one pass counts what every step did.

A ghost has the number of the step that dropped it, a weight (how many rows it stands for), and NULL in every other column, so it
neither breaks later steps nor shapes their statistics. Deduplication adds ghosts up to one row per step and task, so
they never make a group large.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP, WEIGHT, FILLED, NULLS = "__step", "__weight", "__filled_", "__null_"


def opened(df: DataFrame) -> DataFrame:
    """``df`` with an empty ledger."""
    return df.withColumns({STEP: F.lit(None).cast("int"), WEIGHT: F.lit(1).cast("long")})


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (STEP, WEIGHT) and not c.startswith((FILLED, NULLS))]


def alive() -> Column:
    return F.col(STEP).isNull()


def _marks(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in data_columns(df)]


def silenced(df: DataFrame) -> DataFrame:
    """NULL in every data column of a ghost."""
    return df.select(*[F.when(alive(), F.col(f"`{c}`")).alias(c) for c in data_columns(df)], *_marks(df))


def dropped(df: DataFrame, keep: Column, step: int) -> DataFrame:
    """Rows that ``keep`` is not true for become ghosts of ``step``."""
    kept = F.coalesce(keep, F.lit(False))
    return silenced(df.withColumn(STEP, F.coalesce(F.col(STEP), F.when(~kept, F.lit(step)))))


def deduplicated(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool, step: int) -> DataFrame:
    """One living row per key, the first or last in ``order`` (NULLs first); the others are counted as ghosts of ``step``."""
    columns, fills = data_columns(df), [c for c in df.columns if c.startswith(FILLED)]
    row, at = F.struct(*[F.col(f"`{c}`") for c in columns]), F.struct(*[F.col(f"`{c}`") for c in (order or keys)])
    best = F.max_by(row, at) if last else F.min_by(row, at)
    groups = df.groupBy(*[F.col(f"`{k}`").alias(f"__key_{i}") for i, k in enumerate(keys)], STEP).agg(
        F.sum(WEIGHT).alias("__n"), best.alias("__row"), *[F.sum(c).alias(c) for c in fills])
    empty, one = F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType), F.lit(1).cast("long")

    def entry(row: Column, step: Column, weight: Column, filled: bool) -> Column:
        return F.struct(row.alias("__row"), step.cast("int").alias(STEP), weight.alias(WEIGHT),
                        *[(F.col(c) if filled else F.lit(0).cast("long")).alias(c) for c in fills])

    living = F.array(entry(F.col("__row"), F.lit(None), one, True), F.when(F.col("__n") > 1, entry(empty, F.lit(step), F.col("__n") - 1, False)))
    entries = F.when(alive(), living).otherwise(F.array(entry(empty, F.col(STEP), F.col("__n"), True)))
    flat = groups.select(F.inline(F.array_compact(entries)))
    return flat.select(*[F.col("__row")[c].alias(c) for c in columns], STEP, WEIGHT, *fills)


def filled(df: DataFrame, columns: Sequence[str], step: int) -> DataFrame:
    """The number of NULLs that ``step`` filled in each row, from the marks that :func:`with_null_marks` left before it."""
    total = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        total = total + (alive() & F.col(f"{NULLS}{i}") & F.col(f"`{c}`").isNotNull()).cast("long")
    return df.withColumn(f"{FILLED}{step}", total).drop(*[f"{NULLS}{i}" for i in range(len(columns))])


def with_null_marks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{NULLS}{i}": F.col(f"`{c}`").isNull() for i, c in enumerate(columns)})
