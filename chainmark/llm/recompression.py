"""Operator 5: removal of long repeated word sequences by recompression.

A text is rewritten in rounds. The first round names runs of one word; each further round cuts the symbols at
random into left and right ones and names every pair of a left symbol before a right one. A name is a hash of what
it stands for, so all texts agree on it without an exchange, and equal sequences get equal symbols inside. Each
symbol carries the range of words that decides it: a pair depends on its two parts only, a single symbol also on
the neighbour that it did not pair with. A window's anchor is, of the highest round that has symbols decided
inside the window, the one with the lowest name: equal windows hold equal such symbols. Symbols of round 0 are the
words themselves, so every window has an anchor. Shared anchors are then verified by content (see ``repeats``).

Null text has no words. Texts below ``WIDTH`` words keep all. Repeated rows repeat each other's sequences. A task
holds one round of texts, or one longer text, as arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chainmark.llm.repeats import Pieces, covered, judged, with_repeats
from chainmark.llm.text import draws, flat, mix, spread, words

WIDTH, MOST_ROUNDS = 35, 12
_FAR = np.int64(1) << 40


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, _, names, first = words(data, offsets)
    return names, first


class Symbols:
    """Symbols of one round: name, text, first word, and the range of words that decides each."""

    def __init__(self, name, text, start, lo, hi):
        self.name, self.text, self.start, self.lo, self.hi = name, text, start, lo, hi

    def around(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the ranges of the neighbours begin and end; beyond reach where there is no neighbour."""
        before, after = np.full(len(self.lo), -_FAR), np.full(len(self.hi), _FAR)
        same = self.text[1:] == self.text[:-1]
        before[1:][same] = self.lo[:-1][same]
        after[:-1][same] = self.hi[1:][same]
        return before, after

    def runs(self) -> "Symbols":
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(new)))
        before, after = self.around()
        factor = draws(2, 30) | np.uint64(1)
        name = np.where(size > 1, mix(self.name[at] * factor[0] + size.astype(np.uint64) * factor[1]), self.name[at])
        return Symbols(name, self.text[at], self.start[at], before[at], after[at + size - 1])

    def pairs(self, number: int) -> "Symbols":
        right = (mix(self.name ^ draws(1, 31, number)[0]) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(right), bool)
        joins[:-1] = ~right[:-1] & right[1:] & (self.text[:-1] == self.text[1:])
        second = np.zeros(len(right), bool)
        second[1:] = joins[:-1]
        before, after = self.around()
        lo = np.where(right & ~second, np.minimum(before, self.lo), self.lo)
        hi = np.where(~right & ~joins, np.maximum(after, self.hi), self.hi)
        head = np.flatnonzero(joins)
        factor = draws(2, 32 + number) | np.uint64(1)
        name = self.name.copy()
        name[head] = mix(self.name[head] * factor[0] + mix(self.name[head + 1]) * factor[1])
        hi[head] = hi[head + 1]
        keep = ~second
        return Symbols(name[keep], self.text[keep], self.start[keep], lo[keep], hi[keep])


def anchors_of(width: int):
    def anchors(pieces: Pieces, first: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names = pieces[1]
        n = len(names)
        at = np.arange(n)
        rounds = [Symbols(names, np.repeat(np.arange(len(first) - 1), np.diff(first)), at, at, at + 1)]
        rounds.append(rounds[0].runs())
        while len(rounds) < MOST_ROUNDS and (rounds[-1].hi - rounds[-1].lo <= width).any():
            rounds.append(rounds[-1].pairs(len(rounds)))
        key, place = np.zeros(n, np.uint64), np.zeros(n, np.int64)
        open_ = np.zeros(n, bool)
        open_[starts] = True
        for number in range(len(rounds) - 1, -1, -1):
            s = rounds[number]
            lo, hi = np.maximum(s.hi - width, 0), s.lo  # starts of windows that hold the deciding range
            fits = np.flatnonzero(s.hi - s.lo <= width)
            before = np.concatenate(([0], np.cumsum(open_)))
            fits = fits[before[hi[fits] + 1] > before[lo[fits]]]
            fits = fits[np.argsort(s.name[fits], kind="stable")]
            best = np.full(n, len(fits), np.int64)
            count = hi[fits] - lo[fits] + 1
            for a, b in _slices(count):
                np.minimum.at(best, np.repeat(lo[fits[a:b]], count[a:b]) + spread(count[a:b]), np.repeat(np.arange(a, b), count[a:b]))
            got = np.flatnonzero(open_ & (best < len(fits)))
            chosen = fits[best[got]]
            key[got] = mix(s.name[chosen] + draws(1, 60, number)[0])
            place[got] = s.start[chosen]
            open_[got] = False
            if not open_.any():
                break
        return key[starts], place[starts]

    return anchors


def _slices(count: np.ndarray, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of entries whose counts add up to about ``limit``."""
    total = np.cumsum(count)
    cuts = np.unique(np.searchsorted(total, np.arange(limit, (int(total[-1]) if len(total) else 0) + limit, limit), "right"))
    yield from zip(np.concatenate(([0], cuts[:-1])), cuts)
    if len(count) and cuts[-1] < len(count):
        yield cuts[-1], len(count)


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)``; ``kept`` is the remaining words joined by one space."""
    found = with_repeats(docs, ["doc_id"], width, word_units, [anchors_of(width)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for lo, hi, first, row, los, his in judged(batch, 1, word_units):
                gone = covered(first, row, los, his, width)
                bytes_ = data[offsets[lo]:offsets[hi]]
                starts, ends, _, _ = words(bytes_, offsets[lo:hi + 1] - offsets[lo])
                # Kept words with one space behind each, gathered in one go; the last space of a text is cut off.
                begin, size = starts[~gone], (ends - starts)[~gone]
                padded = np.append(bytes_, np.uint8(32))
                source = np.repeat(begin, size + 1) + spread(size + 1)
                source[np.cumsum(size + 1) - 1] = len(bytes_)
                joined = padded[source].tobytes() if len(source) else b""
                kept_before = np.concatenate(([0], np.cumsum(~gone)))[first]
                at = np.concatenate(([0], np.cumsum(size + 1)))[kept_before]
                kept = [joined[a:b - 1] if b > a else b"" for a, b in zip(at[:-1], at[1:])]
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(n - np.diff(kept_before)),
                    pa.array([k.decode() for k in kept], pa.string()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                    ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    long = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    return found.mapInArrow(run, T.StructType([docs.schema["doc_id"], *long, T.StructField("kept", T.StringType()), T.StructField("kept_sha256", T.StringType())]))
