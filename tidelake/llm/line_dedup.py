"""Line dedup: repeated lines are dropped from every document but the first that holds them.

A line's key is the line without white space at both ends, ASCII letters lower-cased. A key of at least ``min_chars``
code points that at least two documents hold keeps its lines in the smallest id only.

1. Every document sends its distinct keys as 128-bit hashes; counts and first holders are added up map-side first.
2. The hashes that repeat are dealt into shards. Each shard is one row: a minimal perfect hash (bit levels in which every
   key has a bit of its own; its rank is the key's place) and, in that order, arrays of fingerprints, counts and first
   holders. A shard has at most about ``SHARD_KEYS`` keys, whatever the corpus.
3. Hashes of documents travel to their shard and are looked up there, a batch at a time, streaming past the arrays.
   Keys with more than 1/``HOT_KEYS`` of all repeated lines would crowd one shard; there are at most ``HOT_KEYS`` of them,
   so they form one more shard that every task holds, and documents look these up where they are.
4. Texts move once, to meet their own list of dropped hashes.

A NULL or empty text is one empty line. A NULL id counts as the largest possible id. Rows that repeat an id are one
document to the counts, and each of them gets a result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import SPACES, as_text_array, mix
from tidelake.session import materialise, parallelism

MIN_CHARS = 10
SHARD_KEYS = 1 << 18
HOT_KEYS = 4096
LAST_ID = 2**63 - 1
INDEX = "shard bigint, n_keys bigint, sizes array<bigint>, bits binary, prints binary, counts binary, holders binary"
RESULT = "n_lines bigint, n_dropped bigint, kept string"


def _key(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """Both halves of the hash of a line's key, as signed numbers; None for a short one."""
    key = line.strip(SPACES).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(key), dtype=np.int64).tolist())


def _level(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(a + np.uint64(level)) ^ mix(b * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))) % np.uint64(size)


class Shard:
    """Fingerprints, counts and first holders of the keys of one shard, in the order of a minimal perfect hash."""

    def __init__(self, sizes, bits: bytes, prints: bytes, counts: bytes, holders: bytes):
        self.sizes = [int(x) for x in sizes]
        self.bits = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))
        self.places = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int64)])
        self.prints, self.counts, self.holders = (np.frombuffer(x, dtype=np.int64) for x in (prints, counts, holders))

    @staticmethod
    def build(shard: int, a: np.ndarray, b: np.ndarray, counts: np.ndarray, holders: np.ndarray) -> dict:
        left, levels, order = np.arange(len(a)), [], []
        ua, ub = a.view(np.uint64), b.view(np.uint64)
        while len(left):
            size = 2 * len(left) + 7 & ~7
            at = _level(ua[left], ub[left], len(levels), size).astype(np.int64)
            taken = np.bincount(at, minlength=size) == 1
            alone = taken[at]
            order.append(left[alone][np.argsort(at[alone])])
            levels.append(taken)
            left = left[~alone]
        order = np.concatenate(order) if order else left
        bits = np.packbits(np.concatenate(levels)) if levels else np.zeros(0, dtype=np.uint8)
        return {"shard": shard, "n_keys": len(a), "sizes": [len(x) for x in levels], "bits": bits.tobytes(),
                "prints": (a ^ b)[order].tobytes(), "counts": counts[order].tobytes(), "holders": holders[order].tobytes()}

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where the fingerprint says that it is not here."""
        found = np.full(len(a), -1, dtype=np.int64)
        ua, ub, start, left = a.view(np.uint64), b.view(np.uint64), 0, np.arange(len(a))
        for level, size in enumerate(self.sizes):
            at = start + _level(ua[left], ub[left], level, size).astype(np.int64)
            hit = self.bits[at] == 1
            place = self.places[at[hit]]
            here = left[hit]
            found[here] = np.where(self.prints[place] == (a ^ b)[here], place, -1)
            left, start = left[~hit], start + size
        return found

    def drops(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether another document holds the key first."""
        place = self.find(a, b)
        out = place >= 0
        out[out] = (self.counts[place[out]] > 1) & (self.holders[place[out]] != doc[out])
        return out


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(a, b, doc)``: the distinct hashes of every row's line keys."""
    def emit(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            doc, keys = [], []
            for i, text in zip(ids, as_text_array(batch.column(1))):
                found = {_key(line, min_chars) for line in text.as_buffer().to_pybytes().split(b"\n")} - {None}
                keys += found
                doc += [i] * len(found)
            pairs = np.array(keys, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                                              pa.array(np.array(doc, dtype=np.int64))], names=["a", "b", "doc"])

    return docs.mapInArrow(emit, "a bigint, b bigint, doc bigint")


def build_index(repeated: DataFrame, n_shards: int) -> DataFrame:
    """One row (``INDEX``) per shard of the repeated keys ``(a, b, n, holder)``."""
    def build(table: pa.Table) -> pa.Table:
        shard, *columns = (table.column(c).to_numpy() for c in ("shard", "a", "b", "n", "holder"))
        row = Shard.build(int(shard[0]), *columns)
        return pa.table({k: [v] for k, v in row.items()}, schema=pa.schema([
            ("shard", pa.int64()), ("n_keys", pa.int64()), ("sizes", pa.list_(pa.int64())),
            *[(c, pa.binary()) for c in ("bits", "prints", "counts", "holders")]]))

    return (repeated.withColumn("shard", F.pmod(F.col("a"), F.lit(n_shards))).groupBy("shard")
            .applyInArrow(build, INDEX))


def probe(lines: DataFrame, index: DataFrame, n_shards: int) -> DataFrame:
    """``(doc, a)`` of every hash that its shard says is dropped from the document."""
    def look_up(batches):
        shard_no, shard = None, None
        for batch in batches:
            shards = batch.column(0).to_numpy()
            a, b, doc = (batch.column(i).fill_null(0).to_numpy() for i in (1, 2, 3))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]])
            hit = np.zeros(len(shards), dtype=bool)
            for start, end in pairwise(edges) if len(shards) else ():
                if batch.column(4)[start].is_valid:
                    shard_no = shards[start]
                    shard = Shard(*(batch.column(i)[start].as_py() for i in range(4, 9)))
                    start += 1
                if shards[start - 1 if start == end else start] == shard_no:
                    hit[start:end] = shard.drops(a[start:end], b[start:end], doc[start:end])
            yield pa.RecordBatch.from_arrays([pa.array(doc[hit]), pa.array(a[hit])], names=["doc", "a"])

    arrays = ("sizes", "bits", "prints", "counts", "holders")
    rows = lines.withColumn("shard", F.pmod(F.col("a"), F.lit(n_shards))).select("shard", "a", "b", "doc")
    both = index.select("shard", *arrays).unionByName(rows, allowMissingColumns=True)
    return (both.select("shard", "a", "b", "doc", *arrays).repartition(n_shards, "shard")
            .sortWithinPartitions(F.col("shard"), F.col("bits").isNull()).mapInArrow(look_up, "doc bigint, a bigint"))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` as ``(row, lines)``: the row itself and a struct ``RESULT``."""
    spark = docs.sparkSession
    doc = F.coalesce(F.col(id_column).cast("bigint"), F.lit(LAST_ID))
    lines = materialise(line_hashes(docs.select(doc.alias("doc"), F.col(text_column).alias("text")), min_chars), "lines")
    repeated = materialise(
        lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("holder"), F.max("doc").alias("last"))
        .filter("holder < last").drop("last"), "repeated-lines")
    keys, rows = repeated.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = repeated.filter(F.col("n") > max(2, rows // HOT_KEYS)).toPandas()
    shared = spark.sparkContext.broadcast(Shard.build(0, *(hot[c].to_numpy(dtype=np.int64) for c in ("a", "b", "n", "holder"))))
    n_shards = max(parallelism(spark), -(-keys // SHARD_KEYS))
    is_hot = repeated.filter(F.col("n") > max(2, rows // HOT_KEYS)).select("a", "b")
    index = materialise(build_index(repeated.join(F.broadcast(is_hot), ["a", "b"], "left_anti"), n_shards), "line-index")
    dropped = (probe(lines.join(F.broadcast(is_hot), ["a", "b"], "left_anti"), index, n_shards)
               .groupBy("doc").agg(F.collect_set("a").alias("gone")))

    @F.arrow_udf(RESULT)
    def drop(text: pa.Array, doc: pa.Array, gone: pa.Array) -> pa.Array:
        row = shared.value
        everywhere = Shard(*(row[k] for k in ("sizes", "bits", "prints", "counts", "holders")))
        n_lines, n_dropped, kept = [], [], []
        for t, d, g in zip(as_text_array(text), doc.to_numpy(), gone):
            all_lines = t.as_buffer().to_pybytes().split(b"\n")
            hashes = [_key(line, min_chars) for line in all_lines]
            pairs = np.array([h or (0, 0) for h in hashes], dtype=np.int64)
            hit = everywhere.drops(pairs[:, 0], pairs[:, 1], np.full(len(pairs), d))
            here = set(g.as_py() or ())
            left = [line for line, h, x in zip(all_lines, hashes, hit) if h is None or not (x or h[0] in here)]
            n_lines.append(len(all_lines))
            n_dropped.append(len(all_lines) - len(left))
            kept.append(b"\n".join(left).decode())
        return pa.StructArray.from_arrays([pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                                           pa.array(kept, pa.string())], names=["n_lines", "n_dropped", "kept"])

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), doc.alias("doc"))
    return (rows.join(dropped, "doc", "left")
            .select("row", drop(F.col(f"row.{text_column}"), "doc", "gone").alias("lines")))
