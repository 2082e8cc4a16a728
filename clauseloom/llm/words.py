"""Words of whole texts as arrays: places and 64-bit hashes, computed on Arrow buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D, so a non-breaking space is part of a word.
Letters A-Z count as a-z in the hashes. Nothing here holds one Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULT), -1, 1 << 64))
WINDOW = 1 << 18  # bytes hashed at a time, so that the arrays stay in cache

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    if fold:
        values[65:91] = values[97:123]
    return values


_FOLDED, _AS_IS = _byte_values(True), _byte_values(False)


class _Cache(dict):
    """Tables worked out once per process; empty again wherever it is sent."""

    def __reduce__(self):
        return dict, ()


_POWERS = _Cache()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(WINDOW * 2, 1 << (n - 1).bit_length()) if n > 0 else WINDOW * 2
    if size not in _POWERS:
        up = np.full(size, _MULT)
        down = np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first): byte spans of all words; words of row i are first[i]:first[i + 1]."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = word[edges]
    stops[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data, starts, ends, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each span, equal for equal bytes (with A-Z as a-z if `fold`)."""
    values = _FOLDED if fold else _AS_IS
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + WINDOW, "right")))
        up, down = _powers(int(ends[to - 1] - low))
        sums = values[data[low : ends[to - 1]]]
        sums *= up[: len(sums)]
        np.cumsum(sums, out=sums)
        s, e = starts[at:to] - low, ends[at:to] - low
        h = sums[e - 1]
        h[s > 0] -= sums[s[s > 0] - 1]
        h *= down[s]
        h += (e - s).astype(np.uint64)
        out[at:to] = mix(h)
        at = to
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every span, one after another."""
    if len(starts) == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def row_blocks(first: np.ndarray, most: int):
    """Runs of rows (lo, hi) with at most `most` words in all, one row at least."""
    lo, n = 0, len(first) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def parts(batch: pa.RecordBatch, text: int, most: int = 3 << 20):
    """Slices of the batch with some `most` bytes of text each, whole rows, one at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(False))
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to
