"""Operator 12: alignment of the tokens that two tokenizers make of the same texts, by interval coalescing.

Each text is encoded by both; a token is a range of the bytes of space + text. All ranges of many texts, A's and B's
together, are sorted by start (``lexsort``), and a running maximum of ends (``maximum.accumulate``) shows the groups: one
ends where the next start reaches the maximum. Within a group every A token is linked to every B token; equal ids are
counted first, so a group expands to its distinct pairs only, each with the number of its links.

Each task writes one row per text with its numbers and its distinct id pairs. Spark counts in how many texts a pair is
linked. Pairs of one text only (absent from the stored counts, so their count is 1) and the ``FREQUENT`` most common ones
are looked up without a shuffle: the latter are broadcast, at most that many rows. The rest, none of them common, is
joined by a shuffle. The highest count of an A id is broadcast: one row for each entry of A's vocabulary at most.

* Texts that are null, empty, or not given back byte by byte by either tokenizer have no tokens: zeros and ''.
* Every row is one text of its own, also with null or repeated ids: a repeated row counts as another document.
* Only the id and text columns are read, so other columns cannot clash. No rows give no rows.
* A text is held whole by one task, with its tokens; groups expand ``SLICE`` pairs at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.llm.bpe import Encoder
from chainmark.llm.joins import stored
from chainmark.llm.text import flat, list_array, rounds, spread
from chainmark.llm.tokens import vocabulary

#: Most common pairs that are broadcast; 40 bytes each.
FREQUENT = 400_000
#: Pairs that a group expands to at a time.
SLICE = 1 << 20


class _Pieces:
    """Bytes of all entries of a vocabulary in one array, and the ids' decimal digits with each ending in another."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def gather(self, ids: np.ndarray) -> np.ndarray:
        size = self.sizes[ids]
        return self.bytes[np.repeat(self.starts[ids], size) + spread(size)]


#: What stands after an id: another of its kind, B's ids of the group, the next group, the end of the text.
_ENDINGS = b",", b"|", b";", b""


class SentencePieces:
    """A sentencepiece model and the bytes of its entries: U+2581 is a space, <0xHH> a byte."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.pieces.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and where each text starts (one more entry than texts)."""
        lists = self.model.encode(texts, num_threads=1, add_bos=False, add_eos=False)
        at = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        return np.concatenate([np.array(x, np.int64) for x in lists] + [np.zeros(0, np.int64)]), at


def coalesced(starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all ranges by start, A (kind 0) first, and the number of each one's group in that order."""
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(new) - 1


def _counted(group: np.ndarray, ids: np.ndarray, n_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group, sorted, and how often each occurs there."""
    keys, times = np.unique(group * n_ids + ids, return_counts=True)
    return keys // n_ids, keys % n_ids, times


class Aligner:
    """Aligns the tokens of many texts at once."""

    def __init__(self, a_path: str, b_path: str):
        self.coder, self.other = Encoder(a_path, special=False), SentencePieces(b_path)
        self.a, self.b = _Pieces(vocabulary(a_path).pieces), _Pieces(self.other.pieces)
        self.n_a, self.n_b = len(self.a.sizes), len(self.b.sizes)
        self.digits = _Pieces([b"%d%b" % (i, e) for i in range(max(self.n_a, self.n_b)) for e in _ENDINGS])

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids by A and B and the text of each; only texts that both give back whole have tokens."""
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            none = np.zeros(0, np.int64)
            return none, none, none, none
        a, a_at = self.coder.encode([" " + texts[i] for i in some])
        b, b_at = self.other.encode([texts[i] for i in some])
        a_doc, b_doc = np.repeat(np.arange(len(some)), np.diff(a_at)), np.repeat(np.arange(len(some)), np.diff(b_at))
        whole = [(" " + texts[i]).encode() for i in some]
        size = np.fromiter(map(len, whole), np.int64, len(whole))
        same = np.ones(len(some), bool)
        for pieces, ids, doc in ((self.a, a, a_doc), (self.b, b, b_doc)):
            same &= np.bincount(doc, pieces.sizes[ids], len(some)).astype(np.int64) == size
        for pieces, ids, doc in ((self.a, a, a_doc), (self.b, b, b_doc)):
            keep = same[doc]
            got = pieces.gather(ids[keep])
            want = np.frombuffer(b"".join(w for w, s in zip(whole, same) if s), np.uint8)
            if not np.array_equal(got, want):
                of = np.repeat(np.flatnonzero(same), size[same])
                same[np.unique(of[got != want])] = False
        place = np.array(some)
        keep_a, keep_b = same[a_doc], same[b_doc]
        return a[keep_a], place[a_doc[keep_a]], b[keep_b], place[b_doc[keep_b]]

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Numbers of each text, its distinct pairs (A id * size of B's vocabulary + B id) and the links of each pair."""
        n = len(texts)
        a, a_doc, b, b_doc = self.tokens(texts)
        # Both tile the same bytes, text after text, so running sums are places in all texts together.
        a_end, b_end = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        ids, doc = np.concatenate((a, b)), np.concatenate((a_doc, b_doc))
        kind = np.concatenate((np.zeros(len(a), np.int8), np.ones(len(b), np.int8)))
        ends = np.concatenate((a_end, b_end))
        order, group = coalesced(np.concatenate((a_end - self.a.sizes[a], b_end - self.b.sizes[b])), ends, kind)
        n_groups = int(group[-1]) + 1 if len(group) else 0
        in_a, first = kind[order] == 0, np.flatnonzero(np.diff(group, prepend=-1))
        a_size, b_size = np.bincount(group[in_a], minlength=n_groups), np.bincount(group[~in_a], minlength=n_groups)
        group_doc = doc[order][first]
        out = {"n_a": np.bincount(a_doc, minlength=n), "n_b": np.bincount(b_doc, minlength=n), "n_groups": np.bincount(group_doc, minlength=n)}
        links = np.zeros(n, np.int64)
        np.add.at(links, group_doc, a_size * b_size)
        out["n_links"], out["groups_sha256"] = links, self.digests(n, ids[order], kind[order], group, doc[order])
        out["pairs"] = self.pairs(n, ids[order], in_a, group, group_doc)
        return out

    def digests(self, n: int, ids: np.ndarray, kind: np.ndarray, group: np.ndarray, doc: np.ndarray) -> list[str]:
        """Digest of ``a1,a2|b1;a3|b2`` of each text; '' where there are no tokens."""
        # Within a group A's ids stand before B's, each in order of start.
        order = np.argsort(group * 2 + kind, kind="stable")
        ids, kind, group, doc = ids[order], kind[order], group[order], doc[order]
        ending = np.zeros(len(ids), np.int64)
        if len(ids):
            ending[:-1] = np.where(doc[1:] != doc[:-1], 3, np.where(group[1:] != group[:-1], 2, np.where(kind[1:] != kind[:-1], 1, 0)))
            ending[-1] = 3
        codes = ids * len(_ENDINGS) + ending
        data = self.digits.gather(codes).tobytes()
        at = np.concatenate(([0], np.cumsum(self.digits.sizes[codes])))[np.searchsorted(doc, np.arange(n + 1))]
        return [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist())]

    def pairs(self, n: int, ids: np.ndarray, in_a: np.ndarray, group: np.ndarray, group_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of all texts, the links of each, and where each text's pairs start."""
        a_group, a_id, a_times = _counted(group[in_a], ids[in_a], self.n_a)
        b_group, b_id, b_times = _counted(group[~in_a], ids[~in_a], self.n_b)
        n_b_here = np.bincount(b_group, minlength=len(group_doc))
        b_first = np.cumsum(n_b_here) - n_b_here
        width = n_b_here[a_group]
        keys, docs, times = [], [], []
        total, lo = np.concatenate(([0], np.cumsum(width))), 0
        while lo < len(a_id):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + SLICE, "right")) - 1)
            w = width[lo:hi]
            mine = np.repeat(np.arange(lo, hi), w)
            other = np.repeat(b_first[a_group[lo:hi]], w) + spread(w)
            part = _summed(group_doc[a_group[mine]], a_id[mine] * self.n_b + b_id[other], a_times[mine] * b_times[other])
            for to, values in zip((docs, keys, times), part):
                to.append(values)
            lo = hi
        none = np.zeros(0, np.int64)
        doc, key, time = (np.concatenate([none, *x]) for x in (docs, keys, times))
        if len(docs) > 1:
            doc, key, time = _summed(doc, key, time)
        return key, time, np.searchsorted(doc, np.arange(n + 1))


def _summed(doc: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair), sorted, with their times added up."""
    if not len(doc):
        return doc, key, times
    low = int(doc.min())
    width = np.int64(int(key.max()) + 1)
    if (int(doc.max()) - low + 1) * int(width) < 1 << 62:  # one sort key instead of two
        order = np.argsort((doc - low) * width + key, kind="stable")
    else:
        order = np.lexsort((key, doc))
    doc, key, times = doc[order], key[order], times[order]
    begin = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))))
    return doc[begin], key[begin], np.add.reduceat(times, begin)


@functools.lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: ``row`` (a number of its own), the id, ``n_a, n_b, n_groups, n_links, groups_sha256``, the distinct
    ``pairs`` (A id * size of B's vocabulary + B id) and the links (``times``) of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, row = _aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        for batch in batches:
            _, offsets = flat(batch.column(1))
            for lo, hi in rounds(offsets):
                out = made.align([t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()])
                key, times, at = out["pairs"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + hi - lo)), batch.column(0).slice(lo, hi - lo), *(pa.array(out[c].astype(np.int64)) for c in _NUMBERS),
                     pa.array(out["groups_sha256"], pa.string()), list_array(key, at, pa.int64()), list_array(times, at, pa.int64())],
                    ["row", id_col, *_NUMBERS, "groups_sha256", "pairs", "times"])
                row += hi - lo

    long, many = T.LongType(), T.ArrayType(T.LongType())
    kind = T.StructType([T.StructField("row", long), docs.schema[id_col], *(T.StructField(c, long) for c in _NUMBERS),
                         T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", many), T.StructField("times", many)])
    return docs.select(id_col, text_col).mapInArrow(run, kind)


def pair_counts(table: DataFrame) -> DataFrame:
    """``(pair, n)``: in how many texts each pair is linked, for pairs of two texts and more."""
    return table.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` pairs have that count or more."""
    level = F.floor(F.log2(F.col("n").cast("double")) + 1e-9).cast("int")
    found = {r["level"]: r["k"] for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k")).collect()}  # at most 63 rows
    total, least = 0, max(found, default=0) + 1
    for at in range(least - 1, 0, -1):
        total += found.get(at, 0)
        if total > most:
            break
        least = at
    return 1 << least


def alignments(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of each text: ``n_best`` links are of a pair
    that no pair of its A id exceeds in texts; ``count_sum`` adds up the texts of the pairs of all links."""
    n_b = len(SentencePieces(b_path).pieces)
    table = stored(aligned(docs, a_path, b_path, id_col, text_col), "align-texts")
    counts = stored(pair_counts(table), "align-counts")
    least = frequent_from(counts, frequent)
    best = counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("n").alias("most"))
    links = table.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    links = links.join(F.broadcast(counts.where(F.col("n") >= least)), "pair", "left")
    if least > 2:
        rare = counts.where(F.col("n") < least).withColumnRenamed("n", "few")
        others = links.where(F.col("n").isNull()).drop("n").join(rare.hint("shuffle_merge"), "pair", "left").withColumnRenamed("few", "n")
        links = links.where(F.col("n").isNotNull()).unionByName(others)
    links = links.withColumn("n", F.coalesce("n", F.lit(1).cast("long"))).withColumn("a", F.floor(F.col("pair") / n_b))
    links = links.join(F.broadcast(best), "a", "left")
    hit = F.col("n") == F.coalesce("most", F.lit(1))
    sums = links.groupBy("row").agg(F.sum(F.when(hit, F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return table.drop("pairs", "times").join(sums, "row", "left").select(
        id_col, *_NUMBERS, F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
