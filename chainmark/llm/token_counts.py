"""Operator 7: number of BPE tokens of each text, by a heap and a linked list, without making identifiers.

A word starts as its bytes, linked left and right. The heap holds adjacent pairs by (rank, place); the lowest is
taken again and again, its right part is unlinked, and the pairs beside it enter the heap. The count is the
number of bytes minus the number of merges. Each task remembers the counts of words it has met, ``KNOWN_WORDS``
at most, then starts anew; results do not change. No shuffle.

Null or empty text has 0 bytes and 0 tokens; every row is kept, also with null or repeated ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.llm.text import flat, rounds
from chainmark.llm.tokens import Splitter, vocabulary

KNOWN_WORDS = 400_000


class Counter:
    def __init__(self, path: str):
        v = vocabulary(path)
        self.rank = {(v.pieces[a], v.pieces[b]): r for r, (a, b) in reversed(list(enumerate(v.merges)))}
        self.split = Splitter(v.special)
        self.special = v.special
        self.known: dict[str, int] = {}

    def merges(self, word: bytes) -> int:
        """Number of merges that a word takes."""
        rank, n = self.rank.get, len(word)
        part: list[bytes | None] = [word[i:i + 1] for i in range(n)]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := rank((part[i], part[i + 1]))) is not None]
        heapify(heap)
        done = 0
        while heap:
            _, i, a, b = heappop(heap)
            j = right[i]
            if j >= n or part[i] != a or part[j] != b:
                continue  # a neighbour was merged since
            part[i], part[j] = a + b, None
            k = right[i] = right[j]
            done += 1
            if k < n:
                left[k] = i
                if (r := rank((part[i], part[k]))) is not None:
                    heappush(heap, (r, i, part[i], part[k]))
            h = left[i]
            if h >= 0 and (r := rank((part[h], part[i]))) is not None:
                heappush(heap, (r, h, part[h], part[i]))
        return done

    def count(self, text: str) -> int:
        known, words = self.known, self.split(text)
        for word in set(words).difference(known):
            data = word.encode()
            known[word] = 1 if word in self.special else len(data) - self.merges(data)
        total = sum(map(known.__getitem__, words))
        if len(known) > KNOWN_WORDS:
            known.clear()
        return total


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            _, offsets = flat(batch.column(1))
            for lo, hi in rounds(offsets):
                counts = [counter.count(t or "") for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets[lo:hi + 1])), pa.array(counts, pa.int64())],
                    [id_col, "n_bytes", "n_tokens"])

    kind = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.select(id_col, text_col).mapInArrow(run, kind).withColumn("over_limit", F.col("n_tokens") > limit)
