"""Operator 9: a quality score from random Fourier features, ridge regression and isotonic calibration.

* Statistics of the whole text (shares of kinds of bytes, word and line shapes, repetition) are standardised and
  mapped to ``FEATURES`` cosines whose inner products approximate a Gaussian kernel.
* Each partition of training rows sums its part of the normal equations, by fold; the few sums are added and solved.
* Models of each fold score the other fold's rows; isotonic regression on these scores turns the score of the
  model of all folds into a probability.

Training takes at most ``FIT_ROWS`` labelled rows, those with the smallest hash of their id, and never rows of the
held-out fifth (crc32 of the id as text, modulo 5, is 0). Everything else covers all rows. Inputs of a score are
the text alone. Null text is empty and gets a score like any text. A null id is not held out and has no label;
repeated rows and labels each count. Without labels every score is 0.5; without rows there is no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.llm.text import EXACT, draws, flat, rounds, words

#: Bound of the training sample, and the number of tasks that sum normal equations.
FIT_ROWS, FIT_TASKS = 20_000, 12
FEATURES, WIDTH, RIDGE = 256, 5.0, 1e-3
THRESHOLD = 0.3
STATISTICS = 22

_KIND = np.full(256, 6, np.int64)  # 0 lower, 1 upper, 2 digit, 3 blank, 4 line end, 5 common marks, 6 other marks, 7 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[[32, 9, 11, 12, 13]], _KIND[10], _KIND[128:] = 0, 1, 2, 3, 4, 7
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = 5


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, STATISTICS))
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * 8 + _KIND[data], minlength=n * 8).reshape(n, 8)
    at_least = np.maximum(size, 1)[:, None]
    out[:, 0:8] = kinds / at_least
    starts, ends, names, first = words(data, offsets, EXACT)
    count = np.diff(first)
    per = np.maximum(count, 1)
    word_doc = np.repeat(np.arange(n), count)
    length = ends - starts
    out[:, 8] = np.log1p(size)
    out[:, 9] = np.log1p(count)
    out[:, 10] = np.bincount(word_doc, length, n) / per
    out[:, 11] = np.sqrt(np.maximum(np.bincount(word_doc, length.astype(float) ** 2, n) / per - out[:, 10] ** 2, 0))
    out[:, 12] = np.bincount(word_doc, length <= 3, n) / per
    out[:, 13] = np.bincount(word_doc, length >= 15, n) / per
    last = _KIND[data[ends - 1]] if len(ends) else np.zeros(0)
    out[:, 14] = np.bincount(word_doc, last == 6, n) / per
    out[:, 15] = np.bincount(word_doc, last == 5, n) / per
    order = np.lexsort((names, word_doc))
    new = np.ones(len(order), bool)
    new[1:] = (names[order][1:] != names[order][:-1]) | (word_doc[order][1:] != word_doc[order][:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(order)))
    run_doc = word_doc[order][new]
    out[:, 16] = np.bincount(run_doc, minlength=n) / per
    most = np.zeros(n)
    np.maximum.at(most, run_doc, runs)
    out[:, 17] = most / per
    out[:, 18] = np.bincount(run_doc, runs * np.log(runs), n) / per / np.maximum(np.log(per), 1)
    same = np.zeros(len(names), bool)
    same[1:] = (names[1:] == names[:-1]) & (word_doc[1:] == word_doc[:-1])
    out[:, 19] = np.bincount(word_doc, same, n) / per
    lines = kinds[:, 4] + 1
    out[:, 20] = np.log1p(size / lines)
    out[:, 21] = np.bincount(word_doc, (length == 1) & (last == 6) if len(ends) else None, n) / per if len(ends) else 0.0
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    knots: np.ndarray
    levels: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = fourier((stats - self.mean) / self.scale) @ self.weights + self.bias
        return np.interp(raw, self.knots, self.levels)


def _normal(n: int, seed: int) -> np.ndarray:
    """Fixed normal draws, by the Box-Muller rule."""
    u = (draws(2 * n, seed) >> np.uint64(11)).astype(float) * 2.0**-53
    return np.sqrt(-2 * np.log(1 - u[:n])) * np.cos(2 * np.pi * u[n:])


_DIRECTIONS = _normal(STATISTICS * FEATURES, 21).reshape(STATISTICS, FEATURES) / WIDTH
_PHASES = (draws(FEATURES, 22) >> np.uint64(11)).astype(float) * 2.0**-53 * 2 * np.pi


def fourier(standard: np.ndarray) -> np.ndarray:
    """Random Fourier features; far outliers are brought in, so that all stay where the kernel has seen rows."""
    return np.sqrt(2.0 / FEATURES) * np.cos(np.clip(standard, -8, 8) @ _DIRECTIONS + _PHASES)


def fold_of(col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % 5


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least squares fit, as knots and levels; neighbours that violate the order are pooled."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of x
    for a, b in zip(x[order], y[order]):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    table = np.array(blocks)
    # One made-up row of either class in each block keeps small blocks off 0 and 1.
    return table[:, 2] / table[:, 1], (table[:, 0] + 0.5) / (table[:, 1] + 1.0)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        data, offsets = flat(batch.column(batch.num_columns - 1))
        for lo, hi in rounds(offsets):
            yield batch.slice(lo, hi - lo), statistics(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])


def _training(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """``(fold, y, stats)`` of the training sample."""
    known = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("double").alias("y"))
    usable = known.where(fold_of() != 0).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(fit_rows)  # at most fit_rows ids
    rows = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id").select((fold_of() % 2).cast("int").alias("fold"), "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, stats in _each(batches):
            lists = pa.FixedSizeListArray.from_arrays(pa.array(stats.reshape(-1)), STATISTICS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["fold", "y", "stats"])

    return rows.mapInArrow(run, "fold int, y double, stats array<double>")


def _partition_sums(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Normal equations by fold: each task adds up its rows and sends one matrix for each fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            stats = np.asarray(batch.column(2).flatten()).reshape(-1, STATISTICS)
            fold, y = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            full = np.column_stack((fourier((stats - mean) / scale), np.ones(len(y)), y))
            for k in np.unique(fold):
                part = full[fold == k]
                total[int(k)] = total.get(int(k), 0.0) + part.T @ part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([m.tobytes() for m in total.values()])], ["fold", "sums"])

    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(run, "fold int, sums binary").collect():  # FIT_TASKS tasks, two folds
        out[r.fold] = out.get(r.fold, 0.0) + np.frombuffer(r.sums).reshape(FEATURES + 2, FEATURES + 2)
    return out


def _solve(sums: np.ndarray) -> tuple[np.ndarray, float]:
    a, c = sums[:-1, :-1].copy(), sums[:-1, -1]
    a[np.arange(FEATURES), np.arange(FEATURES)] += RIDGE * max(sums[-2, -2], 1.0)
    w = np.linalg.solve(a + 1e-9 * np.eye(len(a)), c)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    from chainmark.llm.joins import stored

    rows = stored(_training(docs, labels, fit_rows).repartition(FIT_TASKS), "quality-training")
    cols = [F.get("stats", F.lit(i)) for i in range(STATISTICS)]
    moments = rows.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("m"), F.array(*[F.stddev_pop(c) for c in cols]).alias("s")).first()
    if not moments.n:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), np.zeros(FEATURES), 0.0, np.zeros(1), np.full(1, 0.5))
    mean, scale = np.array(moments.m), np.maximum(np.array(moments.s), 1e-6)
    sums = _partition_sums(rows, mean, scale)
    weights, bias = _solve(sum(sums.values()))
    models = {1 - k: _solve(s) for k, s in sums.items()} if len(sums) > 1 else dict.fromkeys((0, 1), (weights, bias))

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = fourier((np.asarray(batch.column(2).flatten()).reshape(-1, STATISTICS) - mean) / scale)
            fold = np.asarray(batch.column(0))
            raw = np.where(fold == 0, x @ models[0][0] + models[0][1], x @ models[1][0] + models[1][1])
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(1)], ["raw", "y"])

    scored = rows.mapInArrow(cross, "raw double, y double").toPandas()  # at most fit_rows rows (more only where doc_id repeats)
    knots, levels = isotonic(scored.raw.to_numpy(), scored.y.to_numpy())
    return Model(mean, scale, weights, bias, knots, levels)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, stats in _each(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(stats))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def classified(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``."""
    scored = scores(docs, fit(docs, labels, fit_rows))
    return scored.select("doc_id", F.coalesce(fold_of() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    model, columns = fit(docs, labels, fit_rows), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, stats in _each(batches):
            yield part.filter(pa.array(model.score(stats) >= threshold)).select(range(len(columns)))

    named = docs.withColumn("_llm_text", F.col("text"))
    return named.mapInArrow(run, T.StructType(docs.schema.fields))
