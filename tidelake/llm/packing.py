"""Packing token sequences: harmonic classes, filled with a fixed number of pieces, on each worker by itself.

A piece of length l belongs to class k where ``capacity/(k+1) < l <= capacity/k``; k pieces of class k always fit one
sequence. So each class fills its own sequences with k pieces each, without looking at the other classes, and workers
need not talk: there is no shuffle. Documents are cut to suit: into whole sequences, then into the powers of two in the
rest down to ``SHORTEST``, whose classes fill without a gap, and a tail below ``SHORTEST``, whose classes waste little.
What a worker has left in its classes at the end is laid end to end into full sequences, and the last of these into
powers of two, which need no padding.

A sequence id is the worker's partition number times 2^40 plus a running number; a rerun of the same input partitions
gives the same result. NULL and empty texts are the end id alone. NULL ids stay NULL, repeated rows are packed
each, other columns are not looked at.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from functools import lru_cache
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
SHORTEST = 32
BATCH_ROWS = 64
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")


@lru_cache(maxsize=4)
def _loaded(path: str, ranks: str, pattern: str):
    import tiktoken
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    with open(ranks, "rb") as lines:
        known = {base64.b64decode(word): int(i) for word, i in map(bytes.split, lines)}
    return library, tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens=special)


def byte_bpe(path: str, ranks: str, pattern: str, end_id: int = 0) -> Callable[[str], np.ndarray]:
    """``text -> ids, end_id`` as the tokenizers file at ``path`` gives them, special strings in texts included.

    Texts are encoded from the same vocabulary as ranks, which takes a quarter of the time; the first text that a
    worker meets is encoded by both, and a difference is an error.
    """
    checked = []

    def encode(text: str) -> np.ndarray:
        library, fast = _loaded(path, ranks, pattern)
        ids = fast.encode(text, allowed_special="all")
        if not checked and text:
            if ids != library.encode(text, add_special_tokens=False).ids:
                raise ValueError(f"{ranks} does not encode as {path} does")
            checked.append(True)
        ids.append(end_id)
        return np.array(ids, dtype="<u4")

    return encode


def cuts(length: int, capacity: int = CAPACITY, shortest: int = SHORTEST) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document: whole sequences, powers of two, a short tail."""
    start = 0
    while length - start >= capacity:
        yield start, capacity
        start += capacity
    size = capacity // 2
    while size >= shortest:
        if length - start >= size:
            yield start, size
            start += size
        size //= 2
    if start < length:
        yield start, length - start


class Packer:
    """Sequences of one worker. Pieces are ``(doc, start, length)``; ``place`` receives them with their sequence."""

    def __init__(self, first_sequence: int, place: Callable, capacity: int = CAPACITY):
        self.next, self.place, self.capacity, self.open = first_sequence, place, capacity, defaultdict(list)

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, length in pieces:
            self.place(doc, start, length, self.next, offset)
            offset += length
        self.next += 1

    def add(self, doc, start: int, length: int) -> None:
        k = self.capacity // length
        self.open[k].append((doc, start, length))
        if len(self.open[k]) == k:
            self._close(self.open.pop(k))

    def finish(self) -> None:
        """Lay what is left end to end: full sequences, then powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(p[2] for p in left)
        sizes = [self.capacity] * (total // self.capacity) + [
            1 << b for b in reversed(range(self.capacity.bit_length())) if (total % self.capacity) >> b & 1]
        at, used = 0, 0
        for size in sizes:
            pieces, room = [], size
            while room:
                doc, start, length = left[at]
                take = min(room, length - used)
                pieces.append((doc, start + used, take))
                room, used = room - take, used + take
                if used == length:
                    at, used = at + 1, 0
            self._close(pieces)
        self.open.clear()


def pack(docs: DataFrame, encode: Callable[[str], np.ndarray], id_column: str = "doc_id",
         text_column: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row (``PIECES``) per piece. ``capacity`` is a power of two."""
    def run(batches):
        rows = []

        def place(doc, start, length, sequence, offset):
            doc_id, ids = doc
            part = ids[start : start + length]
            rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), len(ids), sequence, offset))

        packer = Packer(TaskContext.get().partitionId() << 40, place, capacity)

        def flush():
            columns = list(zip(*rows)) or [()] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=[f.split()[0] for f in PIECES.split(", ")])

        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(i, BATCH_ROWS)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text or "")
                    doc = (doc_id, ids)
                    for start, length in cuts(len(ids), capacity):
                        packer.add(doc, start, length)
                if len(rows) > 20_000:
                    yield flush()
        packer.finish()
        yield flush()

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, PIECES)
