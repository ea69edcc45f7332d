"""Vectorised word and shingle hashing over Arrow text columns.

A batch of texts is one flat byte array with row offsets. Words are the runs of
bytes outside ``0x20`` and ``0x09-0x0D``; a word never crosses a row. Every step
is a numpy operation over the flat array, cut into blocks of about ``BLOCK``
bytes so that memory does not follow the batch size. A row longer than a block
is a block of its own: rows are never split or shortened.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 3 << 20
MAX_ROWS = 2048

_U = np.uint64
_rng = np.random.default_rng(20240611)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
WORD_CODE = np.where(IS_SPACE, np.uint64(0), BYTE_CODE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_STEP = int(_rng.integers(1, 2**62)) * 2 + 1
GRAM_CODE = _rng.integers(1, 2**62, 64, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix constants)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def blocks(offsets: np.ndarray, size: int = BLOCK, max_rows: int = MAX_ROWS):
    """Row ranges of about ``size`` bytes, at least one row each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), i + max_rows, n)
        yield i, j
        i = j


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, p, p^2, ... (mod 2^64), at least n of them."""
    global _powers
    if len(_powers) < n:
        m = 1 << (int(n) - 1).bit_length()
        out = np.full(m, _STEP, np.uint64)
        out[0] = 1
        _powers = np.multiply.accumulate(out)
    return _powers


class Words:
    """Words of a block of rows: ``start``, ``end`` (byte places), ``row``, ``per_row``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.rows = len(offsets) - 1
        word = ~IS_SPACE[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        first[inner] = word[inner]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[inner - 1] = word[inner - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bound = np.searchsorted(self.start, offsets)
        self.per_row = np.diff(self.bound)
        self.row = np.repeat(np.arange(self.rows), self.per_row)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        s0 = self.start[0]
        code = WORD_CODE[self.data[s0:]]
        gap = np.diff(np.append(self.start, len(self.data)))
        kind = np.int32 if len(code) < 1 << 31 else np.int64
        place = np.arange(len(code), dtype=kind)
        place -= np.repeat((self.start - s0).astype(kind), gap)
        code *= powers(int(gap.max()))[place]
        h = np.add.reduceat(code, self.start - s0)
        return mix(h + (self.end - self.start).astype(np.uint64) * GRAM_CODE[63])


def shingles(words: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every k-word window; a row of fewer words is one window, a
    row without words none."""
    n = words.per_row
    full = np.maximum(n - k + 1, 0)
    count = np.where((full == 0) & (n > 0), 1, full)
    row = np.repeat(np.arange(words.rows), count)
    if not len(row):
        return row, np.zeros(0, np.uint64)
    first = words.bound[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    length = np.minimum(n, k)[row]
    out = length.astype(np.uint64) * GRAM_CODE[62]
    for j in range(k):
        inside = length > j
        if inside.all():
            out += h[first + j] * GRAM_CODE[j]
        else:
            out[inside] += h[first[inside] + j] * GRAM_CODE[j]
    return row, mix(out)


SET_BITS = 52


def row_sets(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 52-bit hashes per row: (row, value ascending in each row, row bounds).

    Row number and hash share one 64-bit key, so one plain sort does it; callers
    pass at most ``MAX_ROWS`` rows at a time.
    """
    key = (row.astype(np.uint64) << _U(SET_BITS)) | (h >> _U(64 - SET_BITS))
    key.sort()
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    r = (key >> _U(SET_BITS)).astype(np.int64)
    return r, key & _U((1 << SET_BITS) - 1), np.searchsorted(r, np.arange(rows + 1))
