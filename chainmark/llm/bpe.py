"""Operator 3: byte-level BPE encoding and decoding in batched numpy merge rounds.

Each task cuts its texts into words and encodes only words it has not met, many at once: the symbols of all of
them lie in one flat array, each round finds the rank of every adjacent pair by binary search over the sorted
pair keys, takes the lowest rank of each word and merges all its occurrences. No shuffle; memory is bounded by
the batch and by ``KNOWN_WORDS`` remembered words, after which the memory starts anew (results do not change).

Null or empty text gives an empty list of ids; repeated rows and null doc_id are kept row by row; only the id
and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.llm.text import flat, list_array, rounds, spread
from chainmark.llm.tokens import Splitter, vocabulary

KNOWN_WORDS = 200_000
_SHIFT = np.int64(1 << 20)


class Encoder:
    """Encodes words in merge rounds and remembers their ids."""

    def __init__(self, path: str, special: bool = True):
        v = vocabulary(path)
        self.special = v.special if special else {}
        self.split = Splitter(self.special)
        self.byte_ids = v.byte_ids
        merges = np.array(v.merges, np.int64).reshape(-1, 2)
        keys = merges[:, 0] * _SHIFT + merges[:, 1]
        made = {p: i for i, p in reversed(list(enumerate(v.pieces)))}
        results = np.array([made[v.pieces[a] + v.pieces[b]] for a, b in v.merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.results = keys[order], order, results
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        key = left * _SHIFT + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys))

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        done_symbol, done_word, none = [], [], len(self.keys)
        while len(symbol):
            rank = np.full(len(symbol), none, np.int64)
            joined = word[:-1] == word[1:]
            rank[:-1][joined] = self._ranks(symbol[:-1][joined], symbol[1:][joined])
            begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(word))))
            over = lowest == none
            if over.any():
                done_symbol.append(symbol[over])
                done_word.append(word[over])
                symbol, word, rank, lowest = symbol[~over], word[~over], rank[~over], lowest[~over]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == lowest)
            # Of overlapping pairs, as in a run of one symbol, every second one is taken, from the left.
            chain = np.flatnonzero(np.concatenate(([True], np.diff(hit) != 1)))
            hit = hit[spread(np.diff(np.append(chain, len(hit)))) % 2 == 0]
            symbol[hit] = self.results[rank[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            symbol, word = symbol[keep], word[keep]
        symbol = np.concatenate([*done_symbol, np.zeros(0, np.int64)])
        word = np.concatenate([*done_word, np.zeros(0, np.int64)])
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if w not in self.special]
        ids, sizes = self.merge([w.encode() for w in plain])
        marks = [w for w in new if w in self.special]
        ids = np.concatenate((ids, np.array([self.special[w] for w in marks], np.int64)))
        sizes = np.concatenate((sizes, np.ones(len(marks), np.int64)))
        n, m = len(self.known), len(plain) + len(marks)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while n + m > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[n:n + m] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:n + m] = sizes
        self.used += len(ids)
        self.known.update(zip(plain + marks, range(n, n + m)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and where each text starts (one more entry than texts)."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        words: list[str] = []
        ends = [0]
        for text in texts:
            words.extend(self.split(text))
            ends.append(len(words))
        new = set(words).difference(self.known)
        if new:
            self._learn(list(new))
        which = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[which]
        ids = self.pool[np.repeat(self.starts[which], sizes) + spread(sizes)]
        at = np.concatenate(([0], np.cumsum(sizes)))
        return ids, at[np.array(ends)]


class Decoder:
    """Bytes of id lists by one gather, then UTF-8 with the replacement character for broken sequences."""

    def __init__(self, path: str):
        pieces = vocabulary(path).pieces
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        size = self.sizes[ids]
        data = self.bytes[np.repeat(self.starts[ids], size) + spread(size)].tobytes()
        at = np.concatenate(([0], np.cumsum(size)))[offsets]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])]


def _typed(df: DataFrame, id_col: str, *more: T.StructField) -> T.StructType:
    return T.StructType([df.schema[id_col], *more])


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Texts of a column in rounds of bounded size."""
    _, offsets = flat(column)
    for lo, hi in rounds(offsets):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def encode(docs: DataFrame, path: str, special: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: token ids of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(path, special)
        for batch in batches:
            for lo, hi, texts in _texts(batch.column(1)):
                ids, at = coder.encode(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), list_array(ids, at, pa.int32())], [id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, _typed(docs, id_col, T.StructField("ids", T.ArrayType(T.IntegerType()))))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, text)`` from ``(id, ids)``; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Decoder(path)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            at = np.asarray(lists.offsets).astype(np.int64)
            ids = np.asarray(lists.flatten()).astype(np.int64)
            texts = coder.decode(ids, at - at[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(run, _typed(encoded, id_col, T.StructField("text", T.StringType())))


def round_trip(docs: DataFrame, path: str, special: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)``: encoding, and decoding of those ids, in one pass over the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, back = Encoder(path, special), Decoder(path)
        for batch in batches:
            for lo, hi, texts in _texts(batch.column(1)):
                ids, at = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), list_array(ids, at, pa.int32()), pa.array(back.decode(ids, at), pa.string())],
                    [id_col, "ids", "decoded"])

    more = T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())
    return docs.select(id_col, text_col).mapInArrow(run, _typed(docs, id_col, *more))


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Digest columns of a round trip: number of ids, and hashes of the ids and of the decoded text."""
    return round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
