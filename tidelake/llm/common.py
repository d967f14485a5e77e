"""Text batches as numpy arrays, and the small helpers that several operators share.

A batch of texts reaches Python as one Arrow buffer. Words and n-grams are found and hashed on that buffer, some
hundred kilobytes at a time, so that no Python object is made per word.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
# Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\v\f\r"

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_CODES[list(SPACES)] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a finaliser of two multiplications)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Texts:
    """Consecutive texts of a batch: their bytes and where each begins. NULL counts as empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte and end of every word, and the position of each text's first word (one more than texts)."""
        inside = ~IS_SPACE[self.data]
        before = np.empty(len(inside) + 1, dtype=bool)
        before[0] = False
        before[1:] = inside
        before[self.offsets[:-1]] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(inside) + 1, dtype=bool)
        after[:-1] = inside
        after[self.offsets[1:]] = False
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        first = starts[0]
        spread = np.diff(np.append(starts, len(self.data)))
        longest = int((ends - starts).max())
        powers = np.cumprod(np.full(longest + 1, _STEP | np.uint64(1), dtype=np.uint64))
        at = np.arange(len(self.data) - first) - np.repeat(starts - first, spread)
        np.minimum(at, longest, out=at)
        terms = _BYTE_CODES[self.data[first:]] * powers[at]
        ends_at = np.repeat(ends - starts, spread)
        terms[at >= ends_at] = 0
        return mix(np.add.reduceat(terms, starts - first) + (ends - starts).astype(np.uint64))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` neighbouring values (runs over the end of a text are the caller's matter)."""
    if len(h) < size:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for i in range(size):
        out = out * _STEP + h[i : i + len(out)]
    return mix(out)


def as_text_array(column: pa.Array) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.cast(pa.large_string()).fill_null("")


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """The texts of an Arrow column in runs of about ``limit`` bytes, each with the row its run begins at."""
    column = as_text_array(column)
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, Texts(raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring ``bounds``; empty runs give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]
