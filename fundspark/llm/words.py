"""Vectorised words, word hashes and n-gram hashes over the bytes of many texts at once.

Words are the runs of bytes other than 0x20 and 0x09-0x0D. All hashes are 64 bits wide, computed
with wrap-around arithmetic, so equal sequences always agree and unequal ones practically never do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD1342543DE82EF95
SLICE_BYTES = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0..n and its inverses modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            pair.append(np.cumprod(p))
        have = (pair[0], pair[1])
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for every span, from one running sum."""
    p, inverse = powers(base, len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * p[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


class Texts:
    """Word spans of the rows of one slice: ``doc`` gives each word's row, ``first`` each row's
    first word (one entry more than rows); ``space`` marks the bytes between words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, space: np.ndarray = SPACE):
        if lower:
            data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        solid = ~space[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.ones(len(data), dtype=bool)
        before[1:] = ~solid[:-1]
        after = np.ones(len(data), dtype=bool)
        after[:-1] = ~solid[1:]
        self.start = np.flatnonzero(solid & (before | edge[:-1]))
        self.end = np.flatnonzero(solid & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(self.rows), np.diff(self.first))

    def word_hash(self) -> np.ndarray:
        return spans_hash(self.data.astype(np.uint64) + np.uint64(1), self.start, self.end, BYTE_BASE)


def ngrams(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of every run of ``n`` words inside one row."""
    if len(words) < n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(len(words)) + n <= last)
    return at, spans_hash(words, at, at + n, WORD_BASE)


def slices(
    column: pa.Array, lower: bool = False, most: int = SLICE_BYTES, space: np.ndarray = SPACE
) -> Iterator[tuple[int, int, Texts]]:
    """Cut a binary column into slices of about ``most`` bytes (a longer row is a slice of its own).
    A null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=n + 1, offset=8 * column.offset) if n else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and offsets[-1] else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        yield low, high, Texts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], lower, space)
        low = high


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def dealt(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): ``order[bounds[p]:bounds[p+1]]`` are the entries of partition ``p``, kept in
    their own order; the partition is the range of the key's mixed value."""
    part = ((mix(keys) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column: row i holds ``values[bounds[i]:bounds[i+1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def flat(column) -> np.ndarray:
    """All values of a list column, one after the other."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False)


def lengths(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
