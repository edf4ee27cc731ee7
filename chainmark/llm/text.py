"""Texts as flat numpy arrays: Arrow buffers, words, 64-bit names of words and of shingles.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Names are random linear hashes of the bytes,
mixed to 64 bits; they are the same in every task, so equal words get equal names everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one round of array work looks at; a longer single text is one round.
CHUNK_BYTES = 512 << 10

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the public splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def draws(n: int, seed: int, start: int = 0) -> np.ndarray:
    """Fixed pseudo-random 64-bit values number ``start`` to ``start + n - 1`` of a seed."""
    step = np.arange(start + 1, start + n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed * 0xD1342543DE82EF95 % 2**64))


EXACT = draws(256, 1)
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]
_POWERS = draws(4096, 2) | np.uint64(1)


def powers(n: int) -> np.ndarray:
    """Odd multiplier of each byte position in a word."""
    global _POWERS
    if n > len(_POWERS):
        _POWERS = draws(max(n, 2 * len(_POWERS)), 2) | np.uint64(1)
    return _POWERS


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and where each starts (one more entry than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def rounds(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... counts[0] - 1, 0, 1, ... counts[1] - 1 and so on."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    return np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = EXACT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and name of each word, and per text the number of its first word (one more entry than texts)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return starts, ends, np.zeros(0, np.uint64), first
    size = ends - starts
    at = np.flatnonzero(inside)
    value = table[data[at]] * powers(int(size.max()))[spread(size)]
    names = np.add.reduceat(value, np.cumsum(size) - size)
    return starts, ends, mix(names + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first


def sequence_names(names: np.ndarray, n: int, seed: int = 3) -> np.ndarray:
    """Name of each run of ``n`` consecutive names, by the position of its first."""
    if len(names) < n:
        return np.zeros(0, np.uint64)
    factor = draws(n, seed) | np.uint64(1)
    total = np.zeros(len(names) - n + 1, np.uint64)
    for i in range(n):
        total += names[i:len(names) - n + 1 + i] * factor[i]
    return mix(total)


def shingle_sets(names: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words of each text, sorted, and where each text's set starts.

    A text with fewer words has its whole sequence as one shingle, a text without words none.
    """
    count = np.diff(first)
    runs = np.where(count >= n, count - n + 1, 0)
    doc = np.repeat(np.arange(len(count)), runs)
    at = np.repeat(first[:-1], runs) + spread(runs)
    values = sequence_names(names, n)[at] if len(at) else np.zeros(0, np.uint64)
    for d in np.flatnonzero((count > 0) & (count < n)):
        whole = names[first[d]:first[d + 1]]
        doc, values = np.append(doc, d), np.append(values, sequence_names(whole, len(whole), 1000 + len(whole)))
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
        doc, values = doc[new], values[new]
    return values, np.searchsorted(doc, np.arange(len(count) + 1))


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow lists from flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
