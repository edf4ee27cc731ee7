"""Operator 8: removal of long repeated byte strings by bucket refinement over suffixes.

Suffixes start in buckets by their first bytes. Each refinement gives a suffix a new bucket identifier from its
own and that of the suffix a few offsets later, reusing the identifiers made before, so the compared length
doubles: 1, 2, 4 ... 256 bytes, and then ``WIDTH``. Identifiers are hashes of content, so all tasks agree on them
without an exchange. Sorting every suffix of a corpus in Spark would move many times its size; so the first 64
bytes elect anchors (the lowest bucket among the suffixes of a window), and Spark refines only buckets of anchors
that hold more than one suffix: by whole bundles of windows, then by anchors of 360 bytes, then by single windows,
each only where the step before left something open (see ``repeats``).

Null text is empty. Texts below ``WIDTH`` bytes keep all. Repeated rows repeat each other's strings. A task holds
one round of texts, or one longer text, as arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chainmark.llm.repeats import Pieces, covered, judged, with_repeats
from chainmark.llm.text import EXACT, flat

WIDTH, SEEDS = 400, (64, 360)
_PLACE = 28


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return EXACT[data], offsets


def _places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offsets


def anchors_of(width: int, seed: int):
    """Anchors: of the suffixes whose first ``seed`` bytes lie in the window, the one in the lowest bucket, then the first."""
    reach = width - seed + 1

    def anchors(pieces: Pieces, first: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names = pieces[seed]
        # Places are packed beside ranks, so longer runs of texts are cut into parts that overlap by a window.
        step = (1 << _PLACE) - reach
        part, found = starts // step, np.empty(len(starts), np.int64)
        for p in np.unique(part):
            mine, lo = part == p, int(p) * step
            found[mine] = lo + lowest(names[lo:lo + step + reach - 1], starts[mine] - lo)
        return names[found], found

    def lowest(bucket: np.ndarray, starts: np.ndarray) -> np.ndarray:
        ranked = (bucket >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(bucket), dtype=np.uint64)
        padded = np.full(-(-len(ranked) // reach) * reach, np.iinfo(np.uint64).max)
        padded[:len(ranked)] = ranked
        blocks = padded.reshape(-1, reach)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        return (np.minimum(behind[starts], ahead[starts + reach - 1]) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)

    return anchors


def without_repeats(docs: DataFrame, width: int = WIDTH, seeds: Sequence[int] = SEEDS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256)``; ``kept`` holds the remaining bytes."""
    found = with_repeats(docs, ["doc_id"], width, byte_units, [anchors_of(width, seed) for seed in seeds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for lo, hi, first, row, los, his in judged(batch, 1, _places):
                gone = covered(first, row, los, his, width)
                edge = np.zeros(len(gone) + 1, bool)
                edge[first] = True
                begins = gone.copy()
                begins[1:] &= ~gone[:-1] | edge[1:-1]
                removed = np.concatenate(([0], np.cumsum(gone)))
                spans = np.concatenate(([0], np.cumsum(begins)))
                bytes_ = data[offsets[lo]:offsets[hi]]
                kept = [bytes_[a:b][~gone[a:b]].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(np.diff(removed[first])), pa.array(np.diff(spans[first])),
                    pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    long = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    return found.mapInArrow(run, T.StructType([docs.schema["doc_id"], *long, T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())]))
