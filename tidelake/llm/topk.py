"""Exact top-k by inner product: M-trees searched best first.

Vectors are whole numbers. Inner product becomes a metric when every vector gets one more component that brings all of
them to the same length: the nearer to the query (which gets 0 there), the larger the product. So M-trees apply.

1. Vectors are dealt by a hash into shards of at most about ``SHARD_ROWS``, and at least one shard per shuffle partition; each shard is bulk-loaded into one tree and
   stored as pages, one row per node: pivots, covering radii, distances to the parent's pivot, and for leaves the vectors.
2. Queries are cut into blocks of at most ``QUERY_ROWS``; a block meets the pages of one shard at a time. For each query,
   nodes wait in a heap by the least distance they may hold. Before a distance is computed, the triangle inequality on the
   stored distances to the parent is asked whether the entry can still matter. Ties go to the smaller id, so
   only what is strictly farther than the k-th best is left out. Products are whole numbers and exact: in double precision while the
   squared length of every vector stays below ``EXACT``, in Python integers beyond; distances, which only prune, allow for rounding. A
   product beyond 64 bits is an error, components beyond are cut to the ends of that range.
3. The best k of every shard meet, at most k rows per query and shard, cut to k again before they are shuffled.

Vectors that are NULL, or hold NULL or non-finite components, take no part; nor do those without an id or with another
number of components than most have. Rows with the query's own id are no candidates; rows that repeat another id are
candidates each. Queries that repeat an id are asked once, with the smallest of their vectors. Fewer than k candidates
give fewer rows, an empty table none. Other columns are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.session import materialise, parallelism

SHARD_ROWS = 1 << 15
QUERY_ROWS = 1024
FANOUT = 16
LEAF_ROWS = 64
#: Up to this squared length no sum on the way to a product can be rounded.
EXACT = float(1 << 53)
PAGE = "node bigint, leaf boolean, width bigint, entries binary, pivots binary, radii binary, to_parent binary, ids binary, vectors binary"
FOUND = "query_id bigint, vec_id bigint, score bigint"


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one row, or of rows to rows."""
    squares = np.einsum("ij,ij->i", points, points)
    if to.ndim == 1:
        return np.sqrt(np.maximum(squares + to @ to - 2 * points @ to, 0))
    return np.sqrt(np.maximum(squares[:, None] + np.einsum("ij,ij->i", to, to)[None] - 2 * points @ to.T, 0))


def build(ids: np.ndarray, vectors: np.ndarray, norm: float) -> list[dict]:
    """The pages of one tree. ``norm`` is at least the squared length of every vector."""
    ids, whole = ids[order := np.lexsort((*vectors.T[:4], ids))], vectors[order].astype(np.int64)
    vectors = whole.astype(np.float64)
    lifted = np.column_stack([vectors, np.sqrt(np.maximum(norm - np.einsum("ij,ij->i", vectors, vectors), 0))])
    pages: list[dict] = []

    def node(members: np.ndarray, parent: np.ndarray | None, depth: int) -> int:
        number = len(pages)
        page = {"node": number, "leaf": len(members) <= LEAF_ROWS or depth > 40, "width": lifted.shape[1]}
        pages.append(page)
        empty = np.zeros(0)
        if page["leaf"]:
            far = _distances(lifted[members], parent) if parent is not None else np.zeros(len(members))
            near = np.argsort(far, kind="stable")
            parts = dict(entries=empty, pivots=empty, radii=empty, to_parent=far[near], ids=ids[members[near]],
                         vectors=whole[members[near]])
        else:
            # Pivots far from each other: each next one is the member farthest from those taken.
            pivot, far = [members[0]], _distances(lifted[members], lifted[members[0]])
            while len(pivot) < FANOUT and far.max() > 0:
                pivot.append(members[int(far.argmax())])
                far = np.minimum(far, _distances(lifted[members], lifted[pivot[-1]]))
            if len(pivot) == 1:  # all alike: even parts
                groups = np.array_split(members, -(-len(members) // LEAF_ROWS))
                pivot = pivot * len(groups)
            else:
                nearest = _distances(lifted[members], lifted[pivot]).argmin(axis=1)
                groups = [members[nearest == i] for i in range(len(pivot))]
            children, at, radii, back = [], [], [], []
            for p, group in zip(pivot, groups):
                if len(group):
                    children.append(node(group, lifted[p], depth + 1))
                    at.append(lifted[p])
                    radii.append(_distances(lifted[group], lifted[p]).max())
                    back.append(0.0 if parent is None else float(_distances(lifted[p][None], parent)[0]))
            parts = dict(entries=np.array(children, dtype=np.int64), pivots=np.array(at), radii=np.array(radii),
                         to_parent=np.array(back), ids=empty, vectors=empty)
        page.update({k: np.ascontiguousarray(v).tobytes() for k, v in parts.items()})
        return number

    if len(ids):
        node(np.arange(len(ids)), None, 0)
    return pages


class Tree:
    """The pages of one shard, in memory while a block of queries is asked."""

    def __init__(self, pages: pd.DataFrame, norm: float):
        self.nodes, self.exact = {}, np.float64 if norm <= EXACT else object
        for p in pages.itertuples(index=False):
            f = lambda x: np.frombuffer(x, dtype=np.float64)
            vectors = np.frombuffer(p.vectors, dtype=np.int64).reshape(-1, p.width - 1).astype(self.exact)
            self.nodes[p.node] = (p.leaf, np.frombuffer(p.entries, dtype=np.int64), f(p.pivots).reshape(-1, p.width), f(p.radii),
                                  f(p.to_parent), np.frombuffer(p.ids, dtype=np.int64), vectors)

    def search(self, own: int, query: np.ndarray, k: int, norm: float) -> list[tuple[int, int]]:
        """The best ``(score, vec_id)`` of this tree, without vectors of id ``own``."""
        # Whole numbers in, either as doubles that hold them or as integers.
        asked = query.astype(np.int64).astype(self.exact)
        query = query.astype(np.float64)
        lifted, length, slack = np.append(query, 0.0), query @ query, 1e-3 + 4e-8 * np.sqrt(norm)
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first

        def reach() -> float:
            """Beyond this distance no vector can be among the k best; a little more than exact, for rounding."""
            if len(best) < k:
                return np.inf
            return np.sqrt(max(length + norm - 2 * best[0][0], 0)) * (1 + 1e-9) + slack

        waiting = [(0.0, 0, 0.0)] if self.nodes else []  # least distance, node, distance to its pivot
        while waiting:
            least, number, to_pivot = heapq.heappop(waiting)
            limit = reach()
            if least > limit:
                break
            leaf, entries, pivots, radii, to_parent, ids, vectors = self.nodes[number]
            if leaf:
                # to_parent is sorted: entries outside the ring cannot be near enough.
                if number:
                    a, b = np.searchsorted(to_parent, (to_pivot - limit, to_pivot + limit))
                else:
                    a, b = 0, len(ids)
                scores = (vectors[a:b] @ asked).astype(np.int64)
                near = ids[a:b]
                if len(best) == k:
                    keep = scores >= best[0][0]
                    scores, near = scores[keep], near[keep]
                for score, vec_id in zip(scores.tolist(), near.tolist()):
                    if vec_id == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -vec_id))
                    elif (score, -vec_id) > best[0]:
                        heapq.heapreplace(best, (score, -vec_id))
            else:
                ask = np.abs(to_pivot - to_parent) - radii <= limit if number else np.ones(len(entries), dtype=bool)
                if ask.any():
                    far = _distances(pivots[ask], lifted)
                    for d, r, child in zip(far.tolist(), radii[ask].tolist(), entries[ask].tolist()):
                        if d - r <= limit:
                            heapq.heappush(waiting, (max(d - r, 0.0), child, d))
        return [(score, -neg) for score, neg in best]


def scaled(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as long; NULL where a component is NULL or not finite."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce(usable, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id",
          vector_column: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row for which ``is_query`` (an expression of ``vec_id``) holds."""
    points = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), scaled(F.col(vector_column), scale).alias("v"))
    points = materialise(points.filter("vec_id IS NOT NULL AND v IS NOT NULL"), "topk-points")
    widths = points.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    width = widths.orderBy(F.desc("n"), "width").first()
    points = points.filter(F.size("v") == (width["width"] if width else 0))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, n_queries, norm = points.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.coalesce(F.max(square), F.lit(0.0))).first()
    norm *= 1 + 1e-12  # at least every squared length, whatever was rounded on the way
    n_shards, n_blocks = max(parallelism(vectors.sparkSession), -(-n // SHARD_ROWS)), max(1, -(-n_queries // QUERY_ROWS))

    def load(rows: pd.DataFrame) -> pd.DataFrame:
        pages = build(rows["vec_id"].to_numpy(), np.array(rows["v"].tolist(), dtype=np.int64), norm)
        return pd.DataFrame(pages).assign(shard=rows["shard"].iloc[0])[["shard", *(c.split()[0] for c in PAGE.split(", "))]]

    # Rows, not ids, are dealt: a vector or an id that repeats is spread over all shards.
    shard = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_shards))
    pages = materialise(points.withColumn("shard", shard).groupBy("shard").applyInPandas(load, f"shard bigint, {PAGE}"), "topk-pages")

    def ask(tree_rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(tree_rows):
            tree = Tree(tree_rows, norm)
            for q in queries.itertuples(index=False):
                found = tree.search(q.query_id, np.array(q.v, dtype=np.int64), k, norm)
                rows += [(q.query_id, vec_id, score) for score, vec_id in found]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    queries = points.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_shards - 1).cast("bigint")))))
    met = pages.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
    found = met.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(ask, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
