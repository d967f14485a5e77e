"""Numeric, lookup and calendar functions, ``Column`` in and ``Column`` out."""

from __future__ import annotations

import datetime as dt
from itertools import chain
from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to a range; NULL stays NULL (``least``/``greatest`` would skip it)."""
    out = c
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def map_values(c: Column, mapping: Mapping[Any, Any], default: Any = None, keep_unmapped: bool = False) -> Column:
    """Look values up in a literal map; unmapped values become ``default``, or stay when ``keep_unmapped``."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, c), c if keep_unmapped else F.lit(default))


def age_days(c: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), c)


def bin_numeric(c: Column, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(-inf, b1], (b1, b2], …``; NULL stays NULL."""
    if len(labels) != len(breaks) + 1:
        raise ValueError("one label more than breaks is needed")
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(breaks, labels):
        out = out.when(c <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def date_key(c: Column) -> Column:
    """Calendar date as the integer yyyymmdd."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def calendar(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and last date of a column, with calendar attributes."""
    day = F.to_date(F.col(column))
    ends = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    days = ends.select(F.explode(F.sequence("a", "b")).alias("full_date"))
    d = F.col("full_date")
    return days.select(date_key(d).alias("date_key"), d, F.dayofmonth(d).alias("day_of_month"),
                       F.dayofweek(d).alias("day_of_week"), F.weekofyear(d).alias("week_of_year"),
                       F.month(d).alias("month"), F.quarter(d).alias("quarter"), F.year(d).alias("year"),
                       F.dayofweek(d).isin(1, 7).alias("is_weekend"))
