"""What the two searches for repeated passages share: window names by doubling, and the Spark rounds that find
windows which start more than once.

A text is a sequence of units (bytes or words). Each window of ``width`` units is tied to one anchor inside it,
chosen from the window's content alone, so equal windows choose equal anchors. Neighbouring windows with the same
anchor form a bundle. Anchors are few, so the rounds move one small row for each bundle:

1. bundles are counted by anchor name and by content; an anchor name that occurs once ends there;
2. a bundle whose whole content occurs again has only repeated windows;
3. the rest, and one bundle of each repeated content with the same anchor name, is bundled again by another kind of
   anchor where there is one, and counted again;
4. of what is still open, each window is compared.

All counts are aggregated before they are shuffled, so copies of a passage cost a row in each task, not one task.
Joins shuffle at every size: what a text is joined to grows with the corpus. Tables go when the next is written.
A text is known by its id and a hash of its content; repeated rows count as texts of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainmark.llm.joins import discard, id_key, stored
from chainmark.llm.text import draws, flat, list_array, mix, rounds, spread

#: First unit, last start and length of spans are packed into one long.
_BITS = 20

#: From bytes and text offsets: names of units, and the first unit of each text (one more entry than texts).
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Pieces:
    """Bucket refinement: names of the pieces of any length from each place on.

    The name of a piece comes from the names of the half that starts at its place and of the half that starts at
    a later one, so lengths double, and shorter names are used again for all longer ones.
    """

    def __init__(self, names: np.ndarray):
        self.made = {1: names}

    def _joined(self, names: np.ndarray, gap: int, step: int) -> np.ndarray:
        if len(names) <= gap:
            return np.zeros(0, np.uint64)
        a, b = draws(2, 100 + step) | np.uint64(1)
        out = names[:-gap] * a
        out += names[gap:] * b
        out ^= out >> np.uint64(32)
        return out

    def __getitem__(self, width: int) -> np.ndarray:
        if width not in self.made:
            half = 1 << (width - 1).bit_length() - 1  # the largest power of two below
            self.made[width] = self._joined(self[half], width - half, width)
        return self.made[width]


#: From pieces, first units and the first units of windows: name and place of the anchor of each window.
Anchors = Callable[[Pieces, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def window_starts(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of each whole window, text by text, and the number of windows of each text."""
    count = np.maximum(np.diff(first) - width + 1, 0)
    return np.repeat(first[:-1], count) + spread(count), count


def _bundles(pieces: Pieces, first: np.ndarray, width: int, anchors: Anchors, starts: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, ...]:
    """Part, anchor name, content name, first and last start of each bundle; a bundle lies in one part."""
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    key, place = anchors(pieces, first, starts)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(starts)) - 1
    a, whole = draws(4, 99) | np.uint64(1), pieces[width]
    content = mix(whole[starts[lo]] * a[0] + mix(whole[starts[hi]] ^ a[1]) + (hi - lo).astype(np.uint64) * a[2] + (place[lo] - starts[lo]).astype(np.uint64) * a[3])
    return part[lo], key[lo].view(np.int64), content.view(np.int64), starts[lo], starts[hi]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(id_key().alias("_id"), F.xxhash64("text").alias("_text"), F.coalesce("text", F.lit("")).alias("_body"))


def _rounds(batch: pa.RecordBatch, column: int, units: Units) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = flat(batch.column(column))
    for lo, hi in rounds(offsets):
        yield lo, hi, *units(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])


_ROW = ["_id", "_text", "key", "content", "lo", "hi", "known"]


def _all_bundles(keyed: DataFrame, width: int, units: Units, anchors: Anchors) -> DataFrame:
    """Bundles of all windows of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, names, first in _rounds(batch, 2, units):
                starts, count = window_starts(first, width)
                text, key, content, lo, hi = _bundles(Pieces(names), first, width, anchors, starts, np.repeat(np.arange(len(count)), count))
                at = pa.array(text + row)
                cols = [key, content, lo - first[text], hi - first[text], np.zeros(len(lo), bool)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, cols)], _ROW)

    return keyed.mapInArrow(run, "_id long, _text long, key long, content long, lo long, hi long, known boolean")


def _asked_starts(batch: pa.RecordBatch, units: Units) -> Iterator[tuple]:
    """Rounds of asked texts: pieces, first units, and row, range, mark and start of each asked window."""
    span, known = (np.asarray(batch.column(i).flatten().to_numpy(zero_copy_only=False)) for i in (3, 4))
    sizes = np.diff(np.asarray(batch.column(3).offsets))
    row = np.repeat(np.arange(len(sizes)), sizes)
    for lo, hi, names, first in _rounds(batch, 2, units):
        mine = (row >= lo) & (row < hi)
        spans = span[mine]
        count = (spans & ((1 << _BITS) - 1)) + 1
        each = np.repeat(np.arange(len(spans)), count)
        rows = row[mine][each]
        yield Pieces(names), first, rows, each, known[mine][each], first[rows - lo] + (spans >> _BITS)[each] + spread(count), lo


def _asked_bundles(asked: DataFrame, width: int, units: Units, anchors: Anchors) -> DataFrame:
    """Bundles, by another kind of anchor, of the asked ranges of windows; their marks stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pieces, first, rows, each, known, starts, row in _asked_starts(batch, units):
                part, key, content, lo, hi = _bundles(pieces, first, width, anchors, starts, each)
                head = np.searchsorted(each, part)
                at, base = pa.array(rows[head]), first[rows[head] - row]
                cols = [key, content, lo - base, hi - base, known[head]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, cols)], _ROW)

    return asked.mapInArrow(run, "_id long, _text long, key long, content long, lo long, hi long, known boolean")


def _windows(asked: DataFrame, width: int, units: Units, anchors: Anchors) -> DataFrame:
    """One row for each asked window, named by its content and by its anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pieces, first, rows, _, known, starts, row in _asked_starts(batch, units):
                if len(starts):
                    at = pa.array(rows)
                    cols = [anchors(pieces, first, starts)[0].view(np.int64), pieces[width][starts].view(np.int64), starts - first[rows - row], known]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *map(pa.array, cols)],
                                                     ["_id", "_text", "key", "content", "start", "known"])

    return asked.mapInArrow(run, "_id long, _text long, key long, content long, start long, known boolean")


def _merged(lists: DataFrame) -> DataFrame:
    """Starts of repeated windows of each text as few ranges: ``lo`` and ``hi`` lists, both ends included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            span = np.asarray(batch.column(2).flatten())
            size = np.diff(np.asarray(batch.column(2).offsets))
            row = np.repeat(np.arange(len(size)), size)
            lo, hi = span >> _BITS, (span >> _BITS) + (span & ((1 << _BITS) - 1))
            order = np.lexsort((lo, row))
            row, lo, hi = row[order], lo[order], hi[order]
            # Rows are shifted apart, so that one running maximum serves all of them.
            shift = row * (int(hi.max(initial=0)) + 2)
            reach = np.maximum.accumulate(hi + shift) if len(hi) else hi
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | ((lo + shift)[1:] > reach[:-1] + 1)
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(row)) - 1
            ends = (reach - shift)[last[:len(at)]]
            where = np.searchsorted(row[at], np.arange(len(size) + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), list_array(lo[at], where, pa.int64()), list_array(ends, where, pa.int64())],
                                             ["_id", "_text", "los", "his"])

    return lists.mapInArrow(run, "_id long, _text long, los array<long>, his array<long>")


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """Rows whose key occurs more than once, and not only in rows marked as known."""
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("known").alias("k")).where("n > 1 and not k").select("key")
    keys = stored(keys, f"{name}-keys")  # a table, so that adaptive execution can split hot keys of the join
    out = stored(rows.join(keys, "key", "left_semi"), name)
    discard(keys)
    return out


def _with_lists(keyed: DataFrame, asked: DataFrame) -> DataFrame:
    return keyed.join(asked, ["_id", "_text"]).select("_id", "_text", "_body", "spans", "marks")


def repeated_starts(docs: DataFrame, width: int, units: Units, kinds: Sequence[Anchors]) -> DataFrame:
    """``(_id, _text, los, his)``: ranges of the starts of windows that also start anywhere else."""
    keyed, asked, found = _keyed(docs), None, []
    place = F.xxhash64("_id", "_text", "lo")
    for anchors in kinds:
        if asked is None:
            bundles = _all_bundles(keyed, width, units, anchors)
        else:
            bundles = _asked_bundles(_with_lists(keyed, asked), width, units, anchors)
        bundles = stored(bundles, "bundles")
        shared = _shared(bundles, "bundles-shared")
        discard(bundles)
        counted = shared.groupBy("key", "content").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("speaker"))
        counted = stored(counted, "bundle-counts")
        contents = counted.groupBy("key").agg(F.count(F.lit(1)).alias("contents"))
        # Contents that matter to a row: its own occurs again, or its anchor has others.
        info = stored(counted.join(contents, "key").where("n > 1 or contents > 1"), "bundle-info")
        span = (F.shiftleft(F.col("lo"), _BITS) + F.col("hi") - F.col("lo")).alias("span")
        ask = (F.col("contents") > 1) & ((F.col("n") == 1) | (place == F.col("speaker")))
        discard(counted)
        met = shared.join(info, ["key", "content"])
        met = stored(met.select("_id", "_text", span, "known", (F.col("n") > 1).alias("again"), ask.alias("ask")), "bundle-met")
        discard(shared, info)
        found.append(met.where("again and not known").select("_id", "_text", "span"))
        lists = met.where("ask").groupBy("_id", "_text").agg(F.sort_array(F.collect_set(F.struct("span", (F.col("known") | F.col("again")).alias("mark")))).alias("a"))
        if asked is not None:
            discard(asked)
        asked = stored(lists.select("_id", "_text", F.col("a.span").alias("spans"), F.col("a.mark").alias("marks")), "bundle-asked")
    windows = stored(_windows(_with_lists(keyed, asked), width, units, kinds[-1]), "windows")
    discard(asked)
    twice = windows.groupBy("key", "content").agg(F.count(F.lit(1)).alias("n"), F.min("known").alias("k")).where("n > 1 and not k").select("key", "content")
    twice = stored(twice, "windows-twice")
    again = windows.where("not known").join(twice, ["key", "content"], "left_semi")
    again = stored(again.select("_id", "_text", F.shiftleft("start", _BITS).alias("span")), "windows-again")
    discard(windows, twice)
    found.append(again)
    spans = reduce(DataFrame.unionByName, found)
    return stored(_merged(spans.groupBy("_id", "_text").agg(F.collect_set("span").alias("spans"))), "repeats")


def with_repeats(docs: DataFrame, columns: list[str], width: int, units: Units, kinds: Sequence[Anchors]) -> DataFrame:
    """The given columns, ``_body`` (the text, empty where null) and the ranges of repeated starts (empty lists for none)."""
    found = repeated_starts(docs, width, units, kinds)
    texts = docs.select(*columns, id_key().alias("_id"), F.xxhash64("text").alias("_text"), F.coalesce("text", F.lit("")).alias("_body"))
    joined = texts.join(found, ["_id", "_text"], "left")
    none = F.array().cast("array<long>")
    return joined.select(*columns, "_body", F.coalesce("los", none).alias("los"), F.coalesce("his", none).alias("his"))


def covered(first: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> np.ndarray:
    """Which units lie in a window that starts in one of the ranges; ``row`` is the text of each range."""
    edge = np.zeros(int(first[-1]) + 1, np.int32)
    np.add.at(edge, first[row] + lo, 1)
    np.add.at(edge, first[row] + hi + width, -1)
    return np.cumsum(edge[:-1]) > 0


def judged(batch: pa.RecordBatch, body: int, units: Units) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rounds of a batch with the text's ranges: first row, end row, first units, and text, start and end of each range."""
    los, his = (np.asarray(batch.column(i).flatten()) for i in (body + 1, body + 2))
    sizes = np.diff(np.asarray(batch.column(body + 1).offsets))
    row = np.repeat(np.arange(len(sizes)), sizes)
    for lo, hi, _, first in _rounds(batch, body, units):
        mine = (row >= lo) & (row < hi)
        yield lo, hi, first, row[mine] - lo, los[mine], his[mine]
