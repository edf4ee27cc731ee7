"""Operator 4: near-duplicate vectors by spherical-cap filters.

* Filter directions are a product code: a turned vector is cut into halves, each half has a codebook of random unit
  directions with both signs, and a filter is one code of each half. A vector's score for a filter is the sum of
  two products, so the best filters are decoded from the best codes of each half without listing all filters.
  A vector's cap is as wide as to take in the ``PASSED`` best filters. One width for all vectors finds less with as
  many filters, as their halves differ in length.
* Two or three product codes, drawn independently, are searched (``books``); a pair is missed only if it shares no
  filter of any. Up to ``CELLS`` dimensions cells of a grid take the place of filters and miss nothing.
* The number of filters grows with the number of vectors, four for each, so that buckets stay small.
* Vectors that share a filter, label and length are compared in double precision. A bucket of more than ``BLOCK``
  vectors is cut into blocks, and pairs of blocks are tasks of their own. A pair counts in its first common
  filter only. A task returns a count for each vector and the edges of a spanning forest, never the pairs.
* Equal vectors with equal labels are one class from the start; copies cost one row each.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a label, link with
nothing. Repeated or null vec_ids are vectors of their own; the component is the smallest non-null vec_id. Only
vec_id, embedding and label are read. The search can miss a link only if two vectors share no filter of any book.
For pairs at the threshold one book misses up to 1 in 1000 (64 dimensions and more, up to 121 million distinct vectors)
or was measured at up to 2.1 in 1000 (three books); as books are independent, the product, below 1e-6, bounds the
misses. Above 121 million distinct vectors this holds while one book misses below 1 in 100, which is not measured.
Pairs above the threshold are missed less often. Below a ``threshold`` of 0.98 no bound is given.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainmark.llm.joins import sized_join, stored
from chainmark.llm.text import list_array, spread
from chainmark.operators.topology import components

THRESHOLD, PASSED, BLOCK = 0.98, 24, 1000
#: Largest codebook whose misses are measured; the largest used below a number of dimensions; dimensions with cells.
MEASURED, FINEST, CELLS = 11_000, ((12, 64), (16, 300), (24, 1000), (64, 11_000)), 8
_PAIRS = 200_000


@functools.lru_cache(maxsize=16)
def codes(dim: int, size: int, book: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A fixed rotation and the codebooks of both halves; each code stands for both signs."""
    rng = np.random.Generator(np.random.PCG64([dim, size, book]))
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = []
    for part in (dim - dim // 2, dim // 2):
        half = rng.standard_normal((size, part))
        half /= np.maximum(np.linalg.norm(half, axis=1, keepdims=True), 1e-300)
        halves.append(half.astype(np.float32))
    return turn, halves[0], halves[1]


def finest(dim: int, size: int) -> int:
    """The size of the codebooks: in few dimensions caps of ``PASSED`` among more filters are narrower than the threshold."""
    return min([size, *[most for below, most in FINEST if dim < below]])


def books(dim: int, size: int) -> int:
    """Independent sets of filters: two where one misses at most 1 pair in 1000 at the threshold, else three."""
    return 2 if dim >= FINEST[-1][0] and size <= MEASURED else 3


def cells(units: np.ndarray) -> np.ndarray:
    """For few dimensions, without misses: the grid cells that may hold the middle of the vector and one at the threshold.

    A cell is as wide as the threshold's distance, so these are two along each axis; linked vectors share their middle's cell.
    """
    dim = units.shape[1]
    wide = np.sqrt(2 - 2 * THRESHOLD) * (1 + 1e-6)
    low = np.floor(units / wide - 0.5).astype(np.int64) + 8
    corners = np.arange(1 << dim)[:, None] >> np.arange(dim) & 1
    return np.sort(((low[:, None, :] + corners) << 4 * np.arange(dim)).sum(axis=2), axis=1)


def _best_codes(scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of both signs with the highest scores, best first, and these scores; a code's negative comes ``size`` later."""
    size = scores.shape[1]
    if most > size:
        scores = np.concatenate((scores, -scores), axis=1)
        best = np.argsort(-scores, axis=1, kind="stable")[:, :most]
        return best, np.take_along_axis(scores, best, 1)
    # One sign of each code scores at least zero, so the best codes are those of the largest size.
    large = np.abs(scores)
    best = np.argpartition(large, size - most, axis=1)[:, size - most:]
    found = np.take_along_axis(large, best, 1)
    order = np.argsort(-found, axis=1, kind="stable")
    best, found = np.take_along_axis(best, order, 1), np.take_along_axis(found, order, 1)
    return best + size * (np.take_along_axis(scores, best, 1) < 0), found


def passed_in_book(units: np.ndarray, size: int, book: int, most: int = PASSED) -> np.ndarray:
    """The best ``most`` filters of each unit vector in one book."""
    dim = units.shape[1]
    turn, first, second = codes(dim, size, book)
    turned = (units @ turn).astype(np.float32)
    k = min(most, 2 * size)
    best_a, a = _best_codes(turned[:, :dim - dim // 2] @ first.T, k)
    best_b, b = _best_codes(turned[:, dim - dim // 2:] @ second.T, k)
    # A sum of the i-th and the j-th best code has i * j - 1 sums at least as high, so it is among the best only if i * j <= most.
    i, j = np.divmod(np.arange(k * k), k)
    i, j = (x[(i + 1) * (j + 1) <= most] for x in (i, j))
    sums = a[:, i] + b[:, j]
    got = np.argpartition(-sums, most - 1, axis=1)[:, :most]
    return (np.take_along_axis(best_a, i[got], 1).astype(np.int64) + 2 * size * book) * (2 * size) + np.take_along_axis(best_b, j[got], 1)


def passed_filters(units: np.ndarray, size: int, most: int = PASSED) -> np.ndarray:
    """The filters of each unit vector's caps, ``most`` of each book, or its cells, in rising order."""
    dim = units.shape[1]
    if dim <= CELLS:
        return cells(units)
    size = finest(dim, size)
    return np.sort(np.concatenate([passed_in_book(units, size, book, most) for book in range(books(dim, size))], axis=1), axis=1)


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe from overflow."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _with_filters(classes: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, length = np.asarray(batch.column(1).flatten()), np.diff(np.asarray(batch.column(1).offsets))
            begin = np.cumsum(length) - length
            for dim in np.unique(length):
                rows = np.flatnonzero(length == dim)
                for at in range(0, len(rows), 512):
                    part = rows[at:at + 512]
                    found = passed_filters(unit(flat[begin[part][:, None] + np.arange(dim)]), size)
                    where = np.arange(len(part) + 1) * found.shape[1]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(part)), list_array(found.reshape(-1), where, pa.int64())], ["cls", "filters"])

    return classes.select("cls", "vector").mapInArrow(run, "cls long, filters array<long>")


def _first_common(left: np.ndarray, right: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Whether no filter below the given one is in both lists."""
    return ~((left[:, :, None] == right[:, None, :]) & (left < filter_[:, None])[:, :, None]).any(axis=(1, 2))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable place of each place, over the given edges."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _compared(rows: DataFrame, threshold: float) -> DataFrame:
    """``(cls, links, root)`` from rows that lie sorted by group: counts of new links, and one edge, of each class."""
    names = ["grp", "side", "split", "filter", "cls", "copies", "vector", "filters"]

    def judge(table: pa.Table) -> pa.RecordBatch:
        grp, side, split, filter_, cls, copies = (table.column(i).to_numpy() for i in range(6))
        lists = [table.column(i).combine_chunks() for i in (6, 7)]
        vectors, length = np.asarray(lists[0].flatten()).astype(float), np.diff(np.asarray(lists[0].offsets))
        begin = np.cumsum(length) - length
        passed = np.asarray(lists[1].flatten())
        wide = np.diff(np.asarray(lists[1].offsets))
        lines = np.full((len(grp), int(wide.max())), np.iinfo(np.int64).max)
        lines[np.repeat(np.arange(len(grp)), wide), spread(wide)] = passed
        step = max(1, 6_000_000 // lines.shape[1] ** 2)
        ends = np.append(np.flatnonzero(grp[1:] != grp[:-1]) + 1, len(grp))
        after = np.repeat(ends, np.diff(np.concatenate(([0], ends)))) - np.arange(len(grp)) - 1
        links, edges = np.zeros(len(grp), np.int64), []
        for dim in np.unique(length):
            rows = np.flatnonzero(length == dim)
            units = np.zeros((len(grp), dim))
            units[rows] = unit(vectors[begin[rows][:, None] + np.arange(dim)])
            for lo, hi in _cuts(after[rows]):
                left = np.repeat(rows[lo:hi], after[rows[lo:hi]])
                right = left + 1 + spread(after[rows[lo:hi]])
                keep = (length[right] == dim) & (~split[left] | (side[left] != side[right])) & (cls[left] != cls[right])
                left, right = left[keep], right[keep]
                for at in range(0, len(left), _PAIRS):
                    a, b = left[at:at + _PAIRS], right[at:at + _PAIRS]
                    near = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
                    a, b = a[near], b[near]
                    edges.append((a, b))
                    for part in range(0, len(a), step):
                        p, q = a[part:part + step], b[part:part + step]
                        new = _first_common(lines[p], lines[q], filter_[p])
                        np.add.at(links, p[new], copies[q[new]])
                        np.add.at(links, q[new], copies[p[new]])
        a, b = (np.concatenate([e[i] for e in edges] or [np.zeros(0, np.int64)]) for i in (0, 1))
        root = _forest(len(grp), a, b)
        some = (links > 0) | (root != np.arange(len(grp)))
        return pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(links[some]), pa.array(cls[root[some]])], ["cls", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            grp = batch.column(0).to_numpy()
            if held and held[-1].column(0)[-1].as_py() != grp[0]:
                yield judge(pa.Table.from_batches(held))
                held = []
            last = int(np.flatnonzero(grp != grp[-1])[-1]) + 1 if (grp != grp[-1]).any() else 0
            if last:
                yield judge(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield judge(pa.Table.from_batches(held))

    return rows.select(names).mapInArrow(run, "cls long, links long, root long")


def _cuts(count: np.ndarray, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    lo = 0
    total = np.concatenate(([0], np.cumsum(count)))
    while lo < len(count):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every vector."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.col("label").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "label", F.when(F.coalesce(fine, F.lit(False)), value).alias("vector"))
    rows = rows.withColumn("cls", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("smallest"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = stored(classes, "caps-classes")
    size = max(16, int(np.ceil(np.sqrt(classes.count()))))
    passed = stored(_with_filters(classes, size), "caps-filters")
    listed = sized_join(passed, classes.select("cls", "label", F.size("vector").alias("dim")), ["cls"])
    places = listed.select("cls", F.explode("filters").alias("filter"), "label", "dim").select("cls", "filter", F.xxhash64("label", "dim", "filter").alias("bucket"))
    places = stored(places, "caps-places")
    crowded = stored(places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "caps-crowded")
    ways = F.ceil(F.col("n") / block).cast("int")
    cut = sized_join(places, crowded, ["bucket"]).select("cls", "filter", "bucket", ways.alias("ways"), F.pmod(F.xxhash64("cls"), ways).cast("int").alias("side"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
    dealt = dealt.select(
        F.xxhash64("bucket", F.least("side", "other"), F.greatest("side", "other")).alias("grp"), "side",
        (F.col("side") != F.col("other")).alias("split"), "filter", "cls")  # split: only pairs of different sides count
    full = dealt.join(classes.select("cls", "copies", "vector"), "cls").join(passed, "cls")
    tasks = full.repartition("grp").sortWithinPartitions("grp", "cls")
    found = stored(_compared(tasks, threshold), "caps-found")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    edges = found.where("cls != root").select(F.col("cls").alias("u"), F.col("root").alias("v")).distinct()
    groups = components(edges.select(F.explode(F.array("u", "v")).alias("v")).distinct(), edges).select(F.col("v").alias("cls"), "root")
    low = groups.join(classes.select("cls", "smallest"), "cls").groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = groups.join(low, "root").select("cls", "component_id")
    judged = classes.select("cls", "copies", "smallest").join(counts, "cls", "left").join(named, "cls", "left")
    judged = stored(judged.select(
        F.col("cls").alias("key"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("links"),
        F.coalesce("component_id", "smallest").alias("low")), "caps-judged")
    keyed = rows.select("vec_id", "cls", F.coalesce("cls", F.xxhash64("vec_id")).alias("key"))
    out = sized_join(keyed, judged, ["key"], "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("low"))
    links = F.when(F.col("cls").isNull(), F.lit(0).cast("long")).otherwise(F.col("links"))
    return out.select("vec_id", links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
