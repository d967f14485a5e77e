"""Near duplicates by Order MinHash, verified by banded alignment.

Texts are sequences of five-word shingles, each labelled with its occurrence (the second time a shingle comes, it is another
label). The similarity of two texts is that of an alignment: the most labels that both hold in the same order, over all
labels of both. It never exceeds the Jaccard similarity, and equals it where nothing has moved.

1. Texts of equal words are one node; from here on copies cost nothing.
2. A sketch takes the labels with the ``LENGTH`` smallest hashes under one of ``SKETCHES`` hash functions and keeps them in
   the order of the text. Nodes that agree in such a tuple share a bucket: at similarity s this happens with about
   ``s ** LENGTH`` per sketch, so of pairs at 0.8 all but 2 in 10 000 meet in some bucket, of pairs at 0.3 three in a
   thousand. Short texts also get tuples of three.
3. First round: every bucket has a leader, the member that most nodes share buckets with, so in a group of copies the one
   nearest to what they were copied from; a node is aligned with the leader it shares most buckets with. One pair per node, however large a bucket is. Links found are joined to components.
4. Further rounds: in a bucket that still holds several components, nodes outside the largest meet a member of that one,
   drawn by a hash that changes with bucket and round, ``PICKS`` per node and round, while this finds new links.
5. Last round: what is left are stragglers, nodes outside the largest component of a bucket. Buckets with the same largest
   component are taken together; its nodes and its stragglers are dealt into cells of bounded size that hold each text once. In a cell a
   straggler is aligned with nodes of other components that share a bucket with it and whose length allows the similarity,
   until a link to that component is found. Rows are nodes and cells, never pairs, and no link between components is lost.
6. Alignment: labels common to both, in the order of one text, give a sequence of places in the other; the longest
   increasing run of it is the alignment. Places further apart than the band, which is as wide as the threshold
   allows, cannot be part of a good one and are left out.

A class is a component; its id is the smallest document id in it. Texts without words (NULL, empty, white space)
are equal to each other and to nothing else; a text of one to four words has one shingle, all of it. Rows that repeat an id
count each. A NULL id is never a class id; where all ids of a class are NULL so is its id, ``class_key`` still tells
classes apart. Other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import Texts, as_text_array, mix, slices, windows
from tidelake.session import materialise

WORDS = 5
THRESHOLD = 0.8
SKETCHES = 48
LENGTH = 8
#: Texts of fewer shingles also get some tuples of ``SHORT_LENGTH``, as small sets share few long ones.
SHORT, SHORT_LENGTH, SHORT_SKETCHES = 32, 3, 16
#: After the first round, nodes are aligned with ``PICKS`` members of other components a round, ``ROUNDS`` times at most.
PICKS, ROUNDS = 3, 8
#: Texts that a cell of a verification gets of each side.
CELL_NODES = 1500
SKETCH = "node bigint, n int, keys array<bigint>"

_SEEDS = np.random.default_rng(77001).integers(1, 2**63, (SKETCHES, 2), dtype=np.uint64) | np.uint64(1)


def labels_of(texts: Texts) -> tuple[list[np.ndarray], np.ndarray]:
    """Per text the occurrence-labelled shingles in order; and a hash of all its words."""
    starts, ends, first = texts.words()
    words = texts.word_hashes(starts, ends)
    runs = windows(words, WORDS)
    whole, out = np.zeros(texts.n, dtype=np.uint64), []
    for i in range(texts.n):
        a, b = first[i], first[i + 1]
        if a == b:
            out.append(np.zeros(0, dtype=np.uint64))
            continue
        powers = np.cumprod(np.full(b - a, 0xD1342543DE82EF95, dtype=np.uint64))
        whole[i] = (words[a:b] * powers).sum(dtype=np.uint64) + np.uint64(b - a)
        shingles = runs[a : b - WORDS + 1] if b - a >= WORDS else whole[i : i + 1]
        order = np.argsort(shingles, kind="stable")
        same = np.concatenate([[False], np.diff(shingles[order]) == 0])
        if same.any():
            begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            nth = np.empty(len(order), dtype=np.uint64)
            nth[order] = (np.arange(len(order)) - begin).astype(np.uint64)
            shingles = mix(shingles + nth * np.uint64(0x9E3779B97F4A7C15))
        out.append(shingles)
    return out, mix(whole)


def _tuples(labels: np.ndarray, length: int, sketches: int) -> np.ndarray:
    """A hash per sketch of its ``length`` smallest labels in the order of the text."""
    n, keys = len(labels), np.zeros(sketches, dtype=np.uint64)
    step = max(1, (1 << 20) // n)
    for at in range(0, sketches, step):
        seeds = _SEEDS[at : min(at + step, sketches)]
        values = labels[None] * seeds[:, :1] + seeds[:, 1:]
        values ^= values >> np.uint64(29)
        least = (np.argpartition(values, length - 1, axis=1)[:, :length] if n > length
                 else np.broadcast_to(np.arange(n), (len(seeds), n)))
        key = np.arange(at, at + len(seeds), dtype=np.uint64) + np.uint64(1000 * length)
        for column in labels[np.sort(least, axis=1)].T:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
        keys[at : at + len(seeds)] = key
    return keys


def sketch(column: pa.Array) -> pa.Array:
    """Node, number of shingles, and bucket keys of each text."""
    nodes, sizes, keys = [], [], []
    for _, texts in slices(column):
        labels, whole = labels_of(texts)
        for one in labels:
            got = _tuples(one, LENGTH, SKETCHES) if len(one) > 1 else np.zeros(0, dtype=np.uint64)
            if 1 < len(one) < SHORT:
                got = np.concatenate([got, _tuples(one, SHORT_LENGTH, SHORT_SKETCHES)])
            sizes.append(len(one))
            keys.append(got.view(np.int64))
        nodes.append(whole.view(np.int64))
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(nodes) if nodes else np.zeros(0, dtype=np.int64)), pa.array(sizes, pa.int32()),
         pa.array(keys, pa.list_(pa.int64()))], names=["node", "n", "keys"])


def node_of(column: pa.Array) -> pa.Array:
    """The node of each text: equal for texts of equal words."""
    parts = [labels_of(texts)[1].view(np.int64) for _, texts in slices(column)]
    return pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64))


def placed_labels(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels in order of value, and the place of each in the text."""
    order = np.argsort(labels, kind="stable")
    return labels[order], order


def alignment(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> float:
    """Similarity of two texts by the alignment of their ``placed_labels`` inside the band; 0 where it is out of reach."""
    (x, at), (y, to) = a, b
    n = len(x) + len(y)
    if not len(x) or not len(y) or min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return 0.0
    found = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = y[found] == x
    if np.count_nonzero(both) < threshold * (n - np.count_nonzero(both)):
        return 0.0
    at, to = at[both], to[found[both]]
    near = np.abs(at - to) <= int(np.ceil((1 - threshold) * n))
    to = to[near][np.argsort(at[near])]
    long = len(to)
    if long and not (np.diff(to) > 0).all():
        ends: list[int] = []
        for place in to.tolist():
            i = bisect_left(ends, place)
            ends[i : i + 1] = [place]
        long = len(ends)
    return long / (n - long)


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    return alignment(placed_labels(a), placed_labels(b), threshold)


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` of nodes that are similar; ``texts`` has one text per node.

    Where pairs are few for each node, each pair meets its two texts. Where they are many, nodes are dealt into ``g``
    parts and each of the ``g * g`` cells gets the texts of two parts, so a text moves 2 g times, not once a pair.
    Both ways give the same.
    """
    pairs = materialise(pairs, "pairs")
    many = pairs.count()
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().count()
    g = max(1, -(-nodes // CELL_NODES))

    def similarity(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(left), 64):
            x, y = (labels_of_all(c.slice(at, 64)) for c in (left, right))
            out += [aligned(p, q, threshold) for p, q in zip(x, y)]
        return pa.array(out, pa.float64())

    def cell(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        labels = dict(zip(rows["node"], map(placed_labels, labels_of_all(pa.array(rows["text"], pa.string())))))
        hit = [alignment(labels[x], labels[y], threshold) >= threshold for x, y in zip(asked["a"], asked["b"])]
        return asked.loc[hit, ["a", "b"]]

    if many <= 2 * nodes * g:
        a, b = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        scored = pairs.join(a, "a").join(b, "b").select("a", "b", F.arrow_udf(similarity, "double")("text_a", "text_b").alias("s"))
        return scored.filter(F.col("s") >= threshold).select("a", "b")
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(g))
    others = F.sequence(F.lit(0).cast("bigint"), F.lit(g - 1).cast("bigint"))
    cells = F.array_distinct(F.concat(F.transform(others, lambda o: part("node") * g + o), F.transform(others, lambda o: o * g + part("node"))))
    held = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node").withColumn("cell", F.explode(cells))
    asked = pairs.withColumn("cell", part("a") * g + part("b"))
    return held.groupBy("cell").cogroup(asked.groupBy("cell")).applyInPandas(cell, "a bigint, b bigint")


def labels_of_all(column: pa.Array) -> list[np.ndarray]:
    return [one for _, texts in slices(as_text_array(column)) for one in labels_of(texts)[0]]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: the smallest node that can be reached.

    Each round every node looks at its smallest neighbour and the links are drawn between those, so nodes melt together
    and rounds grow with the logarithm of the longest path. Every round is written, none is recomputed.
    """
    spark = edges.sparkSession
    links = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    roots = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                           .select("node", F.least("node", "b").alias("root")), "steps")
        if roots is None:
            roots = step
        else:
            new = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = materialise(roots.join(new, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        a, b = (step.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
        links = materialise(links.join(a, "a").join(b, "b").filter("root_a <> root_b").select(
            F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
    return roots if roots is not None else spark.createDataFrame([], "node bigint, root bigint")


def node_classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """From ``doc_id, text``: ``(doc_id, node)`` per row, and ``(node, root)`` of nodes that are linked to others."""
    sketched = materialise(docs.select("doc_id", F.arrow_udf(sketch, SKETCH)("text").alias("s")).select("doc_id", "s.*"), "sketches")
    members = sketched.select("doc_id", "node")
    shared = sketched.select("node", "n", F.explode("keys").alias("key"))
    several = shared.groupBy("key").agg(F.min("node").alias("one"), F.max("node").alias("other")).filter("one < other").select("key")
    buckets = materialise(shared.join(several, "key").distinct(), "buckets")

    # First round: the most central member of a bucket leads it, which is the one that most nodes share buckets with.
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    central = materialise(buckets.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("met")), "central")
    leaders = buckets.join(central, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("lead")).select(
        "key", F.col("lead.node").alias("leader"))
    best = (buckets.join(leaders, "key").filter("node <> leader").groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("node").agg(F.max(F.struct("n", "leader")).alias("best")))
    pairs = materialise(best.select(F.col("node").alias("a"), F.col("best.leader").alias("b")), "pairs")
    needed = buckets.select("node").distinct()
    # Copies of a text melt together before they are shuffled.
    one_each = docs.select(F.arrow_udf(node_of, "bigint")("text").alias("node"), "text").groupBy("node").agg(F.first("text").alias("text"))
    texts = materialise(one_each.join(needed, "node"), "node-texts")
    roots = materialise(components(_verify(pairs, texts, threshold)), "roots")

    # Further rounds: stragglers meet members of the largest component of their buckets.
    for turn in range(ROUNDS):
        inside = _mixed(buckets, roots)
        drawn = (inside.filter("root = top").groupBy("key").agg(
            F.min(F.struct(F.xxhash64("node", "key", F.lit(turn)).alias("h"), "node", F.col("n").alias("size"))).alias("drawn")))
        likely = F.least("n", "drawn.size") >= threshold * F.greatest("n", "drawn.size")
        asked = (inside.filter("root <> top").join(drawn, "key").filter(likely)
                 .select(F.col("node").alias("a"), F.col("drawn.node").alias("b")))
        picks = asked.groupBy("a").agg(*[F.min(F.struct(F.xxhash64("a", "b", F.lit(turn * PICKS + i)).alias("h"), "b")).alias(f"p{i}")
                                         for i in range(PICKS)])
        picks = materialise(picks.select("a", F.explode(F.array_distinct(F.array(*[f"p{i}.b" for i in range(PICKS)]))).alias("b")), "picks")
        found = materialise(_verify(picks, texts, threshold), "links-found")
        new, tried = found.count(), picks.count()
        if new:
            roots = _joined(roots, found)
        if new * 50 <= tried:
            break

    # Last round: whatever is left between components of one bucket.
    return members, _joined(roots, materialise(_straggling(_mixed(buckets, roots), texts, threshold), "links-found"))


def _straggling(inside: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between components that share a bucket: at least one wherever there is one."""
    nodes = materialise(inside.groupBy("top", "node").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.collect_set("key").alias("keys"))
                        .withColumn("straggler", F.col("root") != F.col("top")), "straggling")
    parts = lambda n: F.ceil(n / CELL_NODES).cast("bigint")
    sizes = nodes.groupBy("top").agg(parts(F.count(F.lit(1))).alias("parts"), parts(F.count_if("straggler")).alias("straggler_parts"))
    placed = nodes.join(sizes, "top")
    part = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    columns = ["top", "node", "n", "root", "keys", "straggler"]
    met = placed.select(*columns, F.lit(False).alias("asks"), every("straggler_parts").alias("i"), part("met", "parts").alias("j"))
    asks = placed.filter("straggler").select(*columns, F.lit(True).alias("asks"), part("asks", "straggler_parts").alias("i"), every("parts").alias("j"))

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(labels=list(map(placed_labels, labels_of_all(pa.array(rows["text"], pa.string())))))
        asking = list(rows[rows["asks"]].itertuples(index=False))
        at, by_key, joined, found = list(rows[~rows["asks"]].itertuples(index=False)), defaultdict(list), {}, []
        for place, node in enumerate(at):
            for key in node.keys:
                by_key[key].append(place)

        def find(root):
            while joined.get(root, root) != root:
                root = joined[root]
            return root

        for one in asking:
            for place in sorted({p for key in one.keys for p in by_key[key]}):
                other = at[place]
                if other.straggler and other.node <= one.node or min(one.n, other.n) < threshold * max(one.n, other.n):
                    continue
                a, b = find(one.root), find(other.root)
                if a != b and alignment(one.labels, other.labels, threshold) >= threshold:
                    joined[max(a, b)] = min(a, b)
                    found.append((min(one.node, other.node), max(one.node, other.node)))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    rows = met.unionByName(asks).join(texts, "node")
    return rows.groupBy("top", "i", "j").applyInPandas(cell, "a bigint, b bigint").distinct()


def _mixed(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, n, root, top`` of the buckets that hold several components; ``top`` is the largest one's root."""
    placed = materialise(buckets.select("key", "node", "n").join(roots, "node", "left")
                         .withColumn("root", F.coalesce("root", "node")), "placed")
    per_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    mixed = (per_root.groupBy("key").agg(F.max(F.struct("size", "root")).alias("top"), F.count(F.lit(1)).alias("roots"))
             .filter("roots > 1").select("key", F.col("top.root").alias("top")))
    return materialise(placed.join(mixed, "key"), "mixed")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after further ``links`` between nodes."""
    r = roots.select(F.col("node").alias("x"), F.col("root").alias("r"))
    ends = links
    for end in ("a", "b"):
        ends = ends.join(r, F.col(end) == F.col("x"), "left").withColumn(end, F.coalesce("r", end)).drop("x", "r")
    second = components(ends).select(F.col("node").alias("root"), F.col("root").alias("next"))
    joined = roots.join(second, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    alone = second.join(roots, second["root"] == roots["node"], "left_anti").select(F.col("root").alias("node"), F.col("next").alias("root"))
    return materialise(joined.unionByName(alone), "roots")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, class_key`` per row of ``docs``."""
    members, roots = node_classes(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), threshold)
    named = members.groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left").withColumn(
        "class_key", F.coalesce("root", "node")).select("node", "least", "class_key")
    least = named.groupBy("class_key").agg(F.min("least").alias("class_id"))
    classes = named.join(least, "class_key").select("node", "class_id", "class_key")
    return members.join(classes, "node").select("doc_id", "class_id", "class_key")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each class, one per class, all columns unchanged."""
    _, roots = node_classes(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), threshold)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.arrow_udf(node_of, "bigint")(text_column).alias("node"))
    first = Window.partitionBy("class_key").orderBy(F.col(f"row.{id_column}").asc_nulls_last(), F.xxhash64("row"))
    return (rows.join(roots, "node", "left").withColumn("class_key", F.coalesce("root", "node"))
            .withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("row.*"))
