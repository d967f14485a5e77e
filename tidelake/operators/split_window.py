"""Ordered windows whose partitions may be arbitrarily large.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts a whole key into one task. Here the keys are counted first. Rows of
keys with at most ``hot_rows`` rows take the plain window, about ``TASK_ROWS`` in a task. Rows of larger keys are cut into *blocks* of about
``hot_rows`` rows by a range partitioning over keys, order and tie-break together, so equal order values, NULLs and
texts that begin alike are cut as well; only rows that agree in all of these stay together. The cut rows are written once
to the shared folder, which fixes their blocks whatever is computed again. The window then runs inside (key, block), and
what has to cross a block border (a running total, the last value seen) is one row per hot key and block, joined back.
There is no limit on hot keys or blocks, and nothing is collected or broadcast by hand. Without keys the table itself is
the hot key. Running sums of floating-point values add block totals, so last digits may differ from a plain window.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.session import materialise, parallelism

BLOCK = "__block"
HOT_ROWS = 1_000_000
#: Rows of plain windows that one task gets, however few bytes they make.
TASK_ROWS = 1_000_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; the right key columns are dropped."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


@dataclass
class _Part:
    name: str
    local: Callable[[Sequence[str]], Column]
    edge: Column | None
    carry: Callable[[Column, Window], Column] | None
    after: bool
    merge: Callable[[Column, Column], Column]
    alone: Callable[[Column], Column] = lambda c: c
    carried: Callable | None = None


class SplitWindow:
    """Collects ordered computations over the same keys and order, then adds them all in one pass.

    ``order`` sorts ascending with NULLs first; ``tiebreak`` columns make the order total. All computations use the
    same block cut and one window per direction.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Column | str, tiebreak: Sequence[str] = (),
                 hot_rows: int | None = None, hot: tuple[DataFrame | None, int] | None = None):
        """``hot`` takes over the ``hot`` of an earlier window on the same keys whose rows included these."""
        self.order = F.col(order) if isinstance(order, str) else order
        self.keys = list(keys)
        self.tiebreak = [F.col(c) for c in tiebreak]
        if hot_rows is None:
            hot_rows = int(df.sparkSession.conf.get("tidelake.window.hotRows", str(HOT_ROWS)))
        self.hot, tasks = (hot, 0) if hot else self._count(df, hot_rows)
        large, blocks = self.hot
        self.cold = self.cut = None
        self.whole = self.keys
        if not blocks:
            self.cold = df
        elif not self.keys and blocks == 1:  # no more rows than one block holds: all are one group
            self.cold, self.whole = df.withColumn(BLOCK, F.pmod(F.hash(self.order), F.lit(1))), [BLOCK]
        else:
            rows = df
            if self.keys:
                self.cold = null_safe_join(df, large, self.keys, "left_anti")
                rows = null_safe_join(df, large, self.keys, "left_semi")
            by = [*[F.col(k).asc_nulls_first() for k in self.keys], *self._sort]
            placed = rows.repartitionByRange(blocks, *by).withColumn(BLOCK, F.spark_partition_id())
            self.cut = materialise(placed, "blocks")
        if self.keys and self.cold is not None and tasks > 1:
            self.cold = self.cold.repartition(max(tasks, parallelism(df.sparkSession)), *self.keys)
        self.df = df
        self.parts: list[_Part] = []

    def _count(self, df: DataFrame, hot_rows: int) -> tuple[tuple[DataFrame | None, int], int]:
        """The keys with more than ``hot_rows`` rows, how many blocks their rows make (0: none is), and how many tasks the other rows ask for."""
        if not self.keys:
            return (None, max(1, -(-df.count() // hot_rows))), 0
        counts = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__n"))
        is_hot = F.col("__n") > hot_rows
        total, rest = counts.agg(F.sum(F.when(is_hot, F.col("__n"))), F.sum(F.when(~is_hot, F.col("__n")))).first()
        return (counts.filter(is_hot).drop("__n"), -(-(total or 0) // hot_rows)), -(-(rest or 0) // TASK_ROWS)

    @property
    def _sort(self) -> list[Column]:
        return [self.order.asc_nulls_first(), *[c.asc_nulls_first() for c in self.tiebreak]]

    @property
    def _reverse(self) -> list[Column]:
        return [self.order.desc_nulls_last(), *[c.desc_nulls_last() for c in self.tiebreak]]

    @property
    def _stamp(self) -> Column:
        return F.struct(self.order.alias("o"), *[c.alias(f"t{i}") for i, c in enumerate(self.tiebreak)])

    def _local(self, groups: Sequence[str], reverse: bool = False):
        return Window.partitionBy(*groups).orderBy(*(self._reverse if reverse else self._sort))

    def total(self, name: str, value: Column) -> "SplitWindow":
        """Running sum up to and including the row."""
        return self._sum(name, value, lambda groups: F.sum(value).over(self._local(groups).rowsBetween(Window.unboundedPreceding, 0)))

    def position(self, name: str) -> "SplitWindow":
        """1, 2, 3 … in order; needs a total order to be repeatable."""
        return self._sum(name, F.lit(1).cast("long"), lambda groups: F.row_number().over(self._local(groups)).cast("long"))

    def rank(self, name: str) -> "SplitWindow":
        """Standard rank on ``order`` alone: ties share a rank, also across blocks, and gaps follow."""
        def local(groups):
            return F.rank().over(Window.partitionBy(*groups).orderBy(self.order.asc_nulls_first())).cast("long")

        def carry(rows, across):
            """Rows before the block, and the last order value before it with its rank."""
            before = F.coalesce(F.sum("__n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            same = Window.partitionBy(*self.keys, "__last")
            edges = rows.groupBy(*self.keys, BLOCK).agg(F.count(F.lit(1)).alias("__n"), F.max(F.col(f"__l_{at}")).alias("__top"),
                                                        F.max_by(F.struct(self.order.alias("o")), self._stamp).alias("__last"))
            return (edges.withColumn("__before", before).withColumn("__rank", F.min(F.col("__before") + F.col("__top")).over(same))
                    .select(*self.keys, BLOCK, F.struct(
                        "__before", F.lag("__last").over(across).alias("last"), F.lag("__rank").over(across).alias("rank"))
                        .alias(f"__c_{at}")))

        def merge(own, c):
            tied = c["last"].isNotNull() & self.order.eqNullSafe(c["last"]["o"])
            return F.when(tied, c["rank"]).otherwise(own + c["__before"])

        at = len(self.parts)
        self.parts.append(_Part(name, local, None, None, False, merge, carried=carry))
        return self

    def _sum(self, name: str, value: Column, local: Callable) -> "SplitWindow":
        self.parts.append(_Part(name, local, F.sum(value), lambda e, w: F.sum(e).over(w), False,
                                lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)))
        return self

    def last_seen(self, name: str, value: Column) -> "SplitWindow":
        """Last non-null value at or before the row."""
        local = lambda groups: F.last(value, True).over(self._local(groups).rowsBetween(Window.unboundedPreceding, 0))
        edge = F.max_by(value, F.when(value.isNotNull(), self._stamp))
        self.parts.append(_Part(name, local, edge, lambda e, w: F.last(e, True).over(w), False, F.coalesce))
        return self

    def next_seen(self, name: str, value: Column) -> "SplitWindow":
        """First non-null value at or after the row."""
        local = lambda groups: F.last(value, True).over(self._local(groups, True).rowsBetween(Window.unboundedPreceding, 0))
        edge = F.min_by(value, F.when(value.isNotNull(), self._stamp))
        self.parts.append(_Part(name, local, edge, lambda e, w: F.last(e, True).over(w), True, F.coalesce))
        return self

    def previous(self, name: str, value: Column) -> "SplitWindow":
        """Value of the row before (NULL at the start of a key)."""
        return self._beside(name, value, False)

    def following(self, name: str, value: Column) -> "SplitWindow":
        """Value of the row after (NULL at the end of a key)."""
        return self._beside(name, value, True)

    def _beside(self, name: str, value: Column, after: bool) -> "SplitWindow":
        # Boxed in a struct, so that a NULL value differs from "no such row".
        boxed = F.struct(value.alias("v"))
        local = lambda groups: F.lag(boxed).over(self._local(groups, after))
        edge = (F.min_by if after else F.max_by)(boxed, self._stamp)
        self.parts.append(_Part(name, local, edge, lambda e, w: F.last(e, True).over(w), after,
                                lambda a, b: F.coalesce(a, b)["v"], lambda a: a["v"]))
        return self

    def result(self) -> DataFrame:
        out = [rows for rows in (self._plain(), self._split()) if rows is not None]
        return reduce(DataFrame.unionByName, out)

    def _kept(self) -> list[Column]:
        return [F.col(c) for c in self.df.columns if c not in {p.name for p in self.parts}]

    def _plain(self) -> DataFrame | None:
        if self.cold is None:
            return None
        rows = self.cold.select("*", *[p.local(self.whole).alias(f"__l_{i}") for i, p in enumerate(self.parts)])
        return rows.select(*self._kept(), *[p.alone(F.col(f"__l_{i}")).alias(p.name) for i, p in enumerate(self.parts)])

    def _split(self) -> DataFrame | None:
        if self.cut is None:
            return None
        groups = [*self.keys, BLOCK]
        rows = self.cut.select("*", *[p.local(groups).alias(f"__l_{i}") for i, p in enumerate(self.parts)])
        across = Window.partitionBy(*self.keys) if self.keys else Window.partitionBy(F.lit(0))
        before, after = across.orderBy(F.col(BLOCK).asc()), across.orderBy(F.col(BLOCK).desc())
        plain = [(i, p) for i, p in enumerate(self.parts) if p.carried is None]
        carried = []
        if plain:  # one row per hot key and block: what enters it from the blocks before (or after) it
            edges = self.cut.groupBy(*groups).agg(*[p.edge.alias(f"__e_{i}") for i, p in plain])
            carried.append(edges.select(*groups, *[
                p.carry(F.col(f"__e_{i}"), (after if p.after else before).rowsBetween(Window.unboundedPreceding, -1))
                .alias(f"__c_{i}") for i, p in plain]))
        carried += [p.carried(rows, before) for p in self.parts if p.carried is not None]
        for one in carried:
            rows = null_safe_join(rows, one, groups, "left")
        return rows.select(*self._kept(), *[p.merge(F.col(f"__l_{i}"), F.col(f"__c_{i}")).alias(p.name)
                                            for i, p in enumerate(self.parts)])
