"""Embedding whitening: an exact covariance by polarisation, its leading components, and every row projected on them.

Entries are taken as integers: ``x = floor(SCALE * c)`` of each component ``c`` as double. The fit list is each distinct
vector once; with ``n`` of them and sums ``S`` per dimension, ``y = n * x - S`` is the centred value times ``n``, an integer.

1. Distinct vectors are written once (copies go map-side, so a vector that a third of all rows share is one row per task).
2. One pass gives ``n`` and ``S``, a second the sum of ``y_i ** 2`` for every dimension and of ``(y_i + y_j) ** 2`` for every pair.
   Polarisation: ``2 * sum(y_i * y_j)`` is the second less the two first, so cross-covariances are differences of
   variances. Squares are added up in limbs of ``LIMB`` bits in int64 in each task, then as decimals, so the sums are exact;
   the driver gets one row per pair of dimensions, whatever the corpus.
3. The covariance (each entry rounded once, from whole numbers) goes to ``eigh``.
4. Every row is projected; one more pass over the fit list measures how far the covariance of the whitened values is from the identity.

Rows whose vector is NULL or holds a NULL, NaN or infinite entry take no part. Neither do vectors of another length than most
rows have (ties: the longer). Repeated rows are answered each, count once in the fit, and a NULL id stays NULL. Entries
beyond a 64-bit integer are cut to its ends. A ``deviation`` beyond 64 bits is an error, not a wrong number. A component
without variance (fewer distinct vectors than dimensions, constant dimensions) has NULL as its ``whitened`` value and counts
for no error; where nothing varies ``explained`` is NULL too. Equal eigenvalues leave the choice of their components to ``eigh``;
it is one choice for all rows. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.session import materialise

SCALE = 256
COMPONENTS = 4
#: Bits of a limb of a pair sum, and rows that are added up in int64 at once.
LIMB, BLOCK = 24, 512
_LOW = np.int64((1 << LIMB) - 1)


class Whitening(NamedTuple):
    """A fit: rows, sums per dimension, covariance, eigenvalues and components (columns) by falling eigenvalue."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    def scales(self, components: int) -> np.ndarray:
        """``1 / sqrt(eigenvalue)`` of the leading components; NaN where there is no variance."""
        values = self.values[:components]
        floor = len(self.values) * np.finfo(float).eps * max(self.values[0], 0)
        return np.array([1 / np.sqrt(e) if e > floor else np.nan for e in values])


def integer_vectors(rows: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """``rows`` with ``x``, without those that take no part."""
    entry = lambda c: F.isnotnull(c) & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    whole = F.col(vector).isNotNull() & F.forall(F.col(vector), lambda c: F.coalesce(entry(c.cast("double")), F.lit(False)))
    x = F.transform(F.col(vector), lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    named = rows.filter(whole).select(*[c for c in rows.columns if c != vector], x.alias("x"))
    return named.filter(F.size("x") > 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of an int64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=np.int64)


def _blocks(batches):
    for batch in batches:
        column = batch.column(0)
        for at in range(0, len(column), BLOCK):
            yield _matrix(column.slice(at, BLOCK))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``: int64 where all sums of two stay small, Python integers where they would not."""
    top = max((int(np.abs(x.astype(object)).max()) if x.size else 0) * n, 0) + max(map(abs, sums))
    if top < 1 << (LIMB * 2 + 1):
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def fit(distinct: DataFrame) -> Whitening | None:
    """From a table of distinct integer vectors ``x`` of one length; ``None`` if it is empty."""
    def add(batches):
        total, n = None, 0
        for x in _blocks(batches):
            part = [int(h) * (1 << 32) + int(low) for h, low in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
            total, n = part if total is None else [a + b for a, b in zip(total, part)], n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(-1, len(total)), pa.int32()), "s": pa.array(map(str, [n, *total]))})

    got = distinct.mapInArrow(add, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    if not got:
        return None
    by_place = {r.i: int(r.s) for r in got}
    n, sums = by_place.pop(-1), [by_place[i] for i in range(len(by_place))]

    def squares(batches):
        # Per pair (i, j), i <= j, three sums: of high * high, high * low and low * low limbs. (i, i) is dimension i itself.
        d = len(sums)
        wide: dict[tuple[int, int], int] = {}
        high, cross, low = (np.zeros((d, d), dtype=object) for _ in range(3))
        for x in _blocks(batches):
            y = _centred(x, n, sums)
            for i in range(d):
                z = y[:, i:] + y[:, i : i + 1]
                z[:, 0] = y[:, i]
                if z.dtype == object:
                    for j, s in enumerate((z * z).sum(axis=0), i):
                        wide[i, j] = wide.get((i, j), 0) + int(s)
                    continue
                h, l = z >> LIMB, z & _LOW
                high[i, i:] += (h * h).sum(axis=0)
                cross[i, i:] += (h * l).sum(axis=0)
                low[i, i:] += (l * l).sum(axis=0)
        i, j = np.triu_indices(d)
        parts = [high[i, j], cross[i, j], low[i, j], [wide.get(p, 0) for p in zip(i.tolist(), j.tolist())]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(map(str, p)) for p in parts]],
                                         names=["i", "j", "high", "cross", "low", "wide"])

    limbs = ("high", "cross", "low", "wide")
    rows = (distinct.mapInArrow(squares, "i int, j int, high string, cross string, low string, wide string").groupBy("i", "j")
            .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in limbs]).collect())
    total = {(r.i, r.j): (int(r.high) << 2 * LIMB) + (int(r.cross) << LIMB + 1) + int(r.low) + int(r.wide) for r in rows}
    d, scale = len(sums), 2 * n**3
    covariance = np.empty((d, d))
    for (i, j), s in total.items():
        twice = 2 * s if i == j else s - total[i, i] - total[j, j]
        covariance[i, j] = covariance[j, i] = twice / scale
    values, vectors = np.linalg.eigh(covariance)
    return Whitening(n, sums, covariance, values[::-1].copy(), vectors[:, ::-1].copy())


def projector(model: Whitening, components: int = COMPONENTS):
    """A function ``x column -> struct`` of ``deviation`` and the ``whitened`` values of the leading components."""
    # The mean as a whole part and a rest, so that large entries lose nothing before the projection.
    whole = np.array([s // model.n for s in model.sums], dtype=object)
    rest = np.array([(s % model.n) / model.n for s in model.sums])
    scales = model.scales(components)
    axes = model.vectors[:, : len(scales)]

    def whiten(x: np.ndarray) -> np.ndarray:
        small = all(abs(int(w)) < 1 << 53 for w in whole) and (not x.size or np.abs(x).max() < 1 << 53)
        off = (x - whole.astype(np.int64)).astype(float) if small else (x.astype(object) - whole).astype(float)
        return ((off - rest) @ axes) * scales

    return whiten


def project(model: Whitening, components: int = COMPONENTS):
    """A function ``x column -> struct<deviation, whitened>`` for Spark."""
    whiten, n, sums = projector(model, components), model.n, model.sums

    @F.arrow_udf("deviation bigint, whitened array<double>")
    def run(column: pa.Array) -> pa.Array:
        deviation, white = [], []
        for at in range(0, len(column), BLOCK):
            x = _matrix(column.slice(at, BLOCK))
            y = _centred(x, n, sums)
            exact = y if y.dtype == object or (y.size and float(np.abs(y).max()) ** 2 * y.shape[1] < 2**62) else y.astype(object)
            deviation += (exact * exact).sum(axis=1).tolist()
            white += whiten(x).tolist()
        whitened = pa.array([[None if v != v else v for v in row] for row in white], pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([pa.array(deviation, pa.int64()), whitened], names=["deviation", "whitened"])

    return run


def identity_error(distinct: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """The largest entry, in size, of the whitened fit list's covariance minus the identity."""
    whiten, use = projector(model, components), np.flatnonzero(~np.isnan(model.scales(components)))
    if not len(use):
        return None

    def moments(batches):
        first, second = np.zeros(len(use)), np.zeros((len(use), len(use)))
        for x in _blocks(batches):
            w = whiten(x)[:, use]
            first += w.sum(axis=0)
            second += w.T @ w
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(use) * (len(use) + 1)), pa.int32()),
                                          "s": pa.array(np.concatenate([first, second.ravel()]))})

    got: pd.DataFrame = distinct.mapInArrow(moments, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).toPandas()
    sums = got.sort_values("i")["s"].to_numpy() / model.n
    mean, second = sums[: len(use)], sums[len(use) :].reshape(len(use), len(use))
    return float(np.abs(second - np.outer(mean, mean) - np.eye(len(use))).max())


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` per remaining row and leading component."""
    spark = rows.sparkSession
    schema = f"id {rows.schema[id_column].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    taken = integer_vectors(rows.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v")), "v", scale)
    lengths = taken.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    taken = taken.filter(F.size("x") == lengths["d"])
    distinct = materialise(taken.select("x").distinct(), "whitening")
    model = fit(distinct)
    error = identity_error(distinct, model, components)
    trace = float(np.trace(model.covariance))
    # An eigenvalue that is not above rounding is no variance.
    kept = np.isnan(model.scales(components))
    explained = [None if trace <= 0 else 0.0 if none else float(e / trace) for e, none in zip(model.values, kept)]
    p = taken.select("id", project(model, components)("x").alias("p"))
    out = p.select("id", "p.deviation", F.posexplode("p.whitened").alias("at", "whitened"))
    return out.select(
        "id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(e).cast("double") for e in explained])[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
