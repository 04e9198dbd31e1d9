"""Word shingles of Arrow text columns as 64-bit hashes, whole batches at a time in numpy.

Words are runs of bytes other than ASCII white space, with A-Z lowered. The hash of a word is a
polynomial over a random value per byte, taken from running sums; that of a shingle combines the
hashes of its words. Hashes stand for shingles throughout: two different ones in the sets compared
would have to agree in 64 bits to be taken for one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Text handled at once in a task; a longer text is handled on its own.
SLICE_BYTES = 500_000


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix generator: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWERED_VALUES = _VALUES[_LOWER]
_BASE = 0xD1342543DE82EF95
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of the odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()  # the tables are made anew where they are needed

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            tables = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                tables.append(np.cumprod(steps, dtype=np.uint64))
            if n > 4 * SLICE_BYTES:  # do not hold the tables of one giant text
                return tables[0], tables[1]
            self.up, self.down = tables
        return self.up, self.down


_POWERS = _Powers()


def running_hash(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """n + 1 running sums, from which ``span_hash`` reads the hash of any span."""
    up, _ = _POWERS.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _POWERS.of(len(sums))
    return (sums[end] - sums[start]) * down[start]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, n + 1 offsets) of runs of rows; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    ends = np.frombuffer(offsets, wide, n + 1, column.offset * np.dtype(wide).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
        yield first, last, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words of a slice."""
    return spans(~_IS_SPACE[data], offsets)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the runs of marked bytes within rows."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    bounds = offsets[1:-1]
    cut = bounds[(bounds > 0) & (bounds < len(inside))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words of a slice, in order."""
    starts, ends, rows = words(data, offsets)
    spans = span_hash(running_hash(data, _LOWERED_VALUES), starts, ends)
    return mix64(spans + (ends - starts).astype(np.uint64) * _STEP), rows


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all runs of k words within a row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total = total * _STEP + hashes[j : j + n]
    whole = rows[:n] == rows[k - 1 :]
    return mix64(total[whole]), rows[:n][whole]


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the shingles: runs of k words; of fewer words, the whole sequence as one.

    Rows come in order; shingles within a row in order only for rows of k words and more.
    """
    hashes, rows = word_hashes(data, offsets)
    out, of = grams(hashes, rows, k)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    more, more_of = [out], [of]
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            mine = np.isin(rows, short)
            h, r = grams(hashes[mine], rows[mine], n)
            more.append(h)
            more_of.append(r)
    if len(more) > 1:
        out, of = np.concatenate(more), np.concatenate(more_of)
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """n + 1 bounds of the runs of each row number in a sorted array."""
    return np.searchsorted(rows, np.arange(n + 1))
