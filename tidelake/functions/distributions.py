"""Quantiles of distributions, ``Column`` in and ``Column`` out; no Python runs per row."""

from __future__ import annotations

import math
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The coefficients of the normal quantile published by Wichura (AS 241), highest power first.
CENTRE = ([2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125,
           1971.5909503065514427, 133.14166789178437745, 3.387132872796366608],
          [5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867, 5394.1960214247511077,
           687.1870074920579083, 42.313330701600911252, 1.0])
MIDDLE = ([7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258, 3.64784832476320460504,
           5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734],
          [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459, 0.68976733498510000455,
           1.6763848301838038494, 2.05319162663775882187, 1.0])
TAIL = ([2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093, 0.29656057182850489123,
         1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772],
        [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4, 0.0148753612908506148525,
         0.13692988092273580531, 0.59983220655588793769, 1.0])
#: Degrees of freedom up to which Student's t is summed exactly; an expansion serves the others.
EXACT_DEGREES = 200
HALVINGS = 60


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is named: expressions stay short."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _ratio(x: Column, coefficients: tuple[list[float], list[float]]) -> Column:
    above, below = (F.aggregate(F.array(*[F.lit(v) for v in values]), F.lit(0.0), lambda total, v: total * x + v) for values in coefficients)
    return above / below


def normal_quantile(p: Column) -> Column:
    """The value that a standard normal variable stays below with probability ``p``; NULL outside (0, 1)."""
    def tail(far: Column) -> Column:
        return F.when(far <= 5, _ratio(far - 1.6, MIDDLE)).otherwise(_ratio(far - 5.0, TAIL))

    def value(p: Column) -> Column:
        q = p - 0.5
        centre = q * bound(0.180625 - q * q, lambda r: _ratio(r, CENTRE))
        far = bound(F.sqrt(-F.ln(F.least(p, 1 - p))), tail)
        return F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * far)

    return bound(p.cast("double"), lambda p: F.when((p > 0) & (p < 1), value(p)))


def _within(t: Column, degrees: Column) -> Column:
    """Probability that Student's t lies in ``[-t, t]``: a finite sum over every second degree."""
    odd = degrees % 2 == 1
    first = F.when(odd, 3).otherwise(2)
    places = F.when(degrees >= first, F.sequence(first, degrees, F.lit(2))).otherwise(F.array().cast("array<int>"))

    def summed(cos: Column) -> Column:
        start = F.struct(F.when(odd, cos).otherwise(1.0).alias("term"), F.lit(0.0).alias("total"))
        return F.aggregate(places, start, lambda s, k: F.struct((s["term"] * cos * cos * (k - 1) / k).alias("term"),
                                                               (s["total"] + s["term"]).alias("total")), lambda s: s["total"])

    def probability(angle: Column) -> Column:
        part = F.sin(angle) * bound(F.cos(angle), summed)
        return F.when(odd, 2 / math.pi * (angle + part)).otherwise(part)

    return bound(F.atan(t / F.sqrt(degrees)), probability)


def student_quantile(degrees: Column, outside: Column) -> Column:
    """The t that ``|T|`` exceeds with probability ``outside``; NULL below one degree or outside (0, 1).

    A bisection of a fixed number of steps over ``x = t / (1 + t)`` for few degrees, an expansion around the normal for many.
    """
    def step(few: Column, outside: Column):
        def halve(s: Column, _: Column) -> Column:
            return bound((s["low"] + s["high"]) / 2, lambda x: bound(_within(x / (1 - x), few) < 1 - outside, lambda short: F.struct(
                F.when(short, x).otherwise(s["low"]).alias("low"), F.when(short, s["high"]).otherwise(x).alias("high"))))
        return halve

    def exact(few: Column, outside: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, step(few, outside), lambda s: (s["low"] + s["high"]) / 2)
        return bound(found, lambda x: x / (1 - x))

    def many(v: Column, outside: Column) -> Column:
        return bound(normal_quantile(1 - outside / 2), lambda z: z + (F.pow(z, F.lit(3)) + z) / (4 * v)
                     + (5 * F.pow(z, F.lit(5)) + 16 * F.pow(z, F.lit(3)) + 3 * z) / (96 * v * v)
                     + (3 * F.pow(z, F.lit(7)) + 19 * F.pow(z, F.lit(5)) + 17 * F.pow(z, F.lit(3)) - 15 * z) / (384 * v * v * v))

    def quantile(s: Column) -> Column:
        n, p = s["n"], s["p"]
        usable = (n >= 1) & (p > 0) & (p < 1)
        return F.when(usable & (n <= EXACT_DEGREES), exact(n, p)).when(usable, many(n.cast("double"), p))

    return bound(F.struct(degrees.cast("int").alias("n"), outside.cast("double").alias("p")), quantile)
