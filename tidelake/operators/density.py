"""Noise points of a density check: rows with nothing dense nearby."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DIMENSIONS = 4


def density_noise(df: DataFrame, id_column: str, dimensions: Sequence[str], eps: float, min_points: int) -> DataFrame:
    """Rows that are not core (fewer than ``min_points`` rows within ``eps``, themselves included) and have no
    core row within ``eps``. Distance is Euclidean.

    Equal points are merged first, so copies weigh as a count. Points fall into cells of side ``eps / sqrt(d)``:
    all points of one cell are within ``eps`` of each other, so a cell that holds ``min_points`` rows is core as a
    whole and its own points need no comparison. Only points of sparser cells, fewer than ``min_points`` per cell,
    look at the cells around them, so the work stays linear in the table even around one very full cell.
    """
    if len(dimensions) > MAX_DIMENSIONS:
        raise ValueError(f"at most {MAX_DIMENSIONS} dimensions: the number of neighbour cells grows exponentially")
    d = len(dimensions)
    names = [f"x{i}" for i in range(d)]
    side = eps / d ** 0.5
    reach = int(-(-(d ** 0.5) // 1))
    points = df.groupBy(*[F.col(c).cast("double").alias(n) for c, n in zip(dimensions, names)]).agg(
        F.count(F.lit(1)).alias("w"))
    points = points.dropna(subset=names)
    cell = [F.floor(F.col(n) / side).alias(f"c{i}") for i, n in enumerate(names)]
    points = points.select(*names, "w", *cell)
    cells = [f"c{i}" for i in range(d)]
    weights = points.groupBy(*cells).agg(F.sum("w").alias("cell_weight"))
    dense = weights.filter(F.col("cell_weight") >= min_points).select(*cells)
    sparse = points.join(dense, cells, "left_anti")

    def around(frame: DataFrame) -> DataFrame:
        steps = F.sequence(F.lit(-reach), F.lit(reach))
        for i, c in enumerate(cells):
            frame = frame.withColumn("__step", F.explode(steps)).withColumn(f"n{i}", F.col(c) + F.col("__step"))
        return frame.drop("__step")

    def close() -> Column:
        squares = [(F.col(n) - F.col(f"o_{n}")) * (F.col(n) - F.col(f"o_{n}")) for n in names]
        return reduce(lambda a, b: a + b, squares) <= eps * eps

    def neighbours(frame: DataFrame, others: DataFrame) -> DataFrame:
        right = others.select(*[F.col(c).alias(f"n{i}") for i, c in enumerate(cells)],
                              *[F.col(n).alias(f"o_{n}") for n in names], F.col("w").alias("o_w"))
        return around(frame).join(right, [f"n{i}" for i in range(d)])

    # Core test of a sparse point: sparse neighbours are few; a dense cell is counted by its close points.
    near = neighbours(sparse.drop("w"), points).filter(close())
    counted = near.groupBy(*names).agg(F.sum("o_w").alias("n"))
    cores = counted.filter(F.col("n") >= min_points).select(*names)
    border = counted.filter(F.col("n") < min_points).select(*names)
    border = border.select(*names, *[F.floor(F.col(n) / side).alias(f"c{i}") for i, n in enumerate(names)])
    core_points = cores.select(*names, F.lit(1).alias("w"), *[F.floor(F.col(n) / side).alias(f"c{i}")
                                                             for i, n in enumerate(names)])
    all_core = core_points.unionByName(points.join(dense, cells, "left_semi").select(*core_points.columns))
    touched = neighbours(border, all_core).filter(close()).select(*names).distinct()
    noise = border.join(touched, names, "left_anti").select(*names)
    keyed = df.select(id_column, *[F.col(c).cast("double").alias(n) for c, n in zip(dimensions, names)])
    # Noise points have fewer than ``min_points`` copies, so this join cannot be skewed.
    return keyed.join(noise, names, "left_semi").select(id_column, *[F.col(n).alias(c)
                                                                   for c, n in zip(dimensions, names)])
