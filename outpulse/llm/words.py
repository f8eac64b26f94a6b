"""Word tables of Arrow text columns: bounds and hashes of all words of a batch at once.

The functions run inside Spark tasks. They work on the column's byte buffer
with numpy, so no word becomes a Python object, and they cut long buffers at
word bounds, so memory stays bounded by the bytes of one slice of rows plus
some bytes per word. Null texts count as empty.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE = 2 << 20
_SEGMENT = 1 << 20
_LONG_WORD = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IDENTITY = np.arange(256, dtype=np.uint8)
_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, lower-case letters and every byte of a non-ASCII character, after lower-casing A-Z.
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@functools.cache
def _segment_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(int(_BASE), _SEGMENT), _powers(_inverse(int(_BASE)), _SEGMENT)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalizer that spreads 64-bit keys over all bits."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a text column: ``row``, and ``start`` and ``end`` in ``data``, in order of place."""

    def __init__(self, texts: pa.Array, alnum: bool = False, lower: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if texts.null_count:
            texts = texts.fill_null("")
        if not pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        n = len(texts)
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.rows = n
        self.lower = lower
        inside = (_ALNUM if alnum else _NOT_SPACE)[self.data]
        cut = np.zeros(len(self.data) + 1, dtype=bool)
        cut[self.offsets] = True
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        self.start = np.flatnonzero(after & (~before | cut))
        self.end = np.flatnonzero(before & (~after | cut))
        self.row = np.searchsorted(self.offsets, self.start, side="right") - 1

    def per_row(self) -> np.ndarray:
        """Number of words of every row."""
        return np.bincount(self.row, minlength=self.rows)

    def bounds(self) -> np.ndarray:
        """Places in the word table where each row's words begin, and the table's end."""
        return np.concatenate(([0], np.cumsum(self.per_row())))

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word's bytes, whatever its place."""
        powers, inverse = _segment_powers()
        table = (_LOWER if self.lower else _IDENTITY).astype(np.uint64) + np.uint64(1)
        out = np.empty(len(self.start), dtype=np.uint64)
        i, n = 0, len(self.start)
        while i < n:
            base = self.start[i]
            j = int(np.searchsorted(self.end, base + _SEGMENT, side="right"))
            if j <= i or self.end[i] - base > _LONG_WORD:
                out[i] = self._long(i)
                i += 1
                continue
            part = table[self.data[base : self.end[j - 1]]]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * powers[: len(part)], dtype=np.uint64)))
            s, e = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = mix((sums[e] - sums[s]) * inverse[s], 1) ^ mix((e - s).astype(np.uint64), 2)
            for k in np.flatnonzero(e - s > _LONG_WORD):
                out[i + k] = self._long(i + k)
            i = j
        return out

    def _long(self, i: int) -> int:
        word = self.data[self.start[i] : self.end[i]]
        word = _LOWER[word] if self.lower else word
        return int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), "little")


def windows(hashes: np.ndarray, row: np.ndarray, length: int, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First places and 64-bit keys of all windows of ``length`` words inside one row."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    base = _WINDOW_BASES[kind]
    powers, inverse = _powers(base, n), _powers(_inverse(base), n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes, 11 + kind) * powers, dtype=np.uint64)))
    at = np.flatnonzero(row[: n - length + 1] == row[length - 1 :])
    return at, mix((sums[at + length] - sums[at]) * inverse[at], 17 + kind)


def slices(batch: pa.RecordBatch | pa.Table, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch | pa.Table]:
    """The batch in runs of rows whose texts hold about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
