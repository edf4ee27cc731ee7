"""Paths along edges, cut from arrays: where a range and all edges it may meet lie in one task, its path never crosses an exchange."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Vertices of a batch handed on, unless one path has more.
BATCH_VERTICES = 1 << 16


class Edges(NamedTuple):
    """Edges in the order of their line; ``ordered`` where neither starts nor ends ever go back."""

    m0: np.ndarray
    m1: np.ndarray
    x1: np.ndarray
    y1: np.ndarray
    x2: np.ndarray
    y2: np.ndarray
    xe: np.ndarray
    ye: np.ndarray
    ordered: bool


def _along(e, at: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """G7 as ``linear._along``: positions at measures ``m`` on the edges ``at``."""
    m0, m1, x1, y1 = e[0][at], e[1][at], e[2][at], e[3][at]
    with np.errstate(all="ignore"):
        share = np.where(m1 == m0, 1.0, (m - m0) / (m1 - m0))
        share = np.fmin(np.maximum(share, 0.0), 1.0)
        return x1 + share * (e[4][at] - x1), y1 + share * (e[5][at] - y1)


def packed(parts: list[list[np.ndarray]]) -> Edges:
    """Edges of several blocks as arrays, with the position where each ends."""
    e = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0)] * 6
    ordered = bool((e[0][1:] >= e[0][:-1]).all() and (e[1][1:] >= e[1][:-1]).all())
    return Edges(*e, *_along(e, slice(None), e[1]), ordered)


def _legs(e: Edges, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per range its first edge, the number of edges it meets, and for edges out of order their numbers in a row."""
    if e.ordered:
        point = a == b
        first = np.where(point, np.searchsorted(e.m1, a, "left"), np.searchsorted(e.m1, a, "right"))
        last = np.where(point, np.searchsorted(e.m0, b, "right"), np.searchsorted(e.m0, b, "left")) - 1
        return first, np.maximum(last - first + 1, 0), np.empty(0, np.int64)
    met = [np.flatnonzero((p <= e.m1) & (q >= e.m0) if p == q else (p < e.m1) & (q > e.m0)) for p, q in zip(a, b)]
    return np.array([m[0] if len(m) else 0 for m in met], np.int64), np.array([len(m) for m in met], np.int64), np.concatenate(met)


def cut(e: Edges, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Paths of the ranges that meet an edge: row numbers, sizes, and the coordinates of all vertices, some ranges at a time."""
    first, met, listed = _legs(e, a, b)
    rows = np.flatnonzero(met)
    ahead = np.concatenate(([0], np.cumsum(met)))
    total = np.concatenate(([0], np.cumsum(met[rows] + 1)))
    lo = 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + BATCH_VERTICES, "right")) - 1)
        some, lo = rows[lo:hi], hi
        f, n, p, q = first[some], met[some], a[some], b[some]
        size = n + 1
        head = np.cumsum(size) - size
        if e.ordered:
            at = np.arange(head[-1] + size[-1]) - np.repeat(head - f + 1, size)
            x, y = e.xe[at], e.ye[at]
            # Ends beyond the range: the last edge, and those before it that end a rounding error behind its start.
            back, late = 0, np.arange(len(some))
            while len(late):
                edge = f[late] + n[late] - 1 - back
                where = head[late] + n[late] - back
                x[where], y[where] = _along(e, edge, np.minimum(q[late], e.m1[edge]))
                back += 1
                late = late[n[late] > back]
                late = late[e.m1[f[late] + n[late] - 1 - back] > q[late]]
        else:
            at = np.zeros(head[-1] + size[-1], np.int64)
            legs = np.ones(len(at), bool)
            legs[head] = False
            at[legs] = np.concatenate([listed[ahead[r]:ahead[r + 1]] for r in some])
            x, y = _along(e, at, np.minimum(np.repeat(q, size), e.m1[at]))
        x[head], y[head] = _along(e, f, np.maximum(p, e.m0[f]))
        yield some, *_unrepeated(size, head, x, y)


def _same(v: np.ndarray) -> np.ndarray:
    return (v[1:] == v[:-1]) | (np.isnan(v[1:]) & np.isnan(v[:-1]))


def _unrepeated(size: np.ndarray, head: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``linear._unrepeated`` for many paths: without immediate repeats beyond two vertices."""
    again = np.concatenate(([False], _same(x) & _same(y)))
    again[head] = False
    if not again.any():
        return size, x, y
    kept = ~again | np.repeat(size <= 2, size)
    kept[head[np.add.reduceat(kept, head) < 2] + 1] = True
    return np.add.reduceat(kept, head), x[kept], y[kept]


def points(size: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"]))


def lengths(size: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """G4 as ``geometry.line_length``: the legs of each path added up in order."""
    with np.errstate(all="ignore"):
        dx, dy = np.diff(x), np.diff(y)
        legs = np.sqrt(dx * dx + dy * dy)
        heads = np.cumsum(size) - size
        return np.array([np.cumsum(legs[lo:lo + n - 1])[-1] for lo, n in zip(heads.tolist(), size.tolist())], np.float64)


def paths(key: str, length: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows sorted by tile, in each the blocks of edges (``_edges``) before the ranges: ``(line_id, key, pts)``, and the length of each path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, parts, edges = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {c: batch.column(c) for c in batch.schema.names}
            tags = [column["line_id"].dictionary_encode().indices.to_numpy(), *(column[c].to_numpy() for c in ("_level", "_tile", "_kind", "_salt"))]
            turns = np.flatnonzero(np.any([t[1:] != t[:-1] for t in tags], axis=0)) + 1
            for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
                here = (column["line_id"][lo].as_py(), *(int(t[lo]) for t in (tags[1], tags[2], tags[4])))
                if here != tile:
                    tile, parts, edges = here, [], None
                if tags[3][lo] == 0:
                    flat = column["_edges"].slice(lo, hi - lo).flatten()
                    names = [f.name for f in flat.type]
                    fields = dict(zip(names, flat.flatten()))
                    parts.append([fields[c].to_numpy(zero_copy_only=False).copy() for c in Edges._fields[:6]])
                    continue
                if edges is None:
                    edges, parts = packed(parts), []
                ends = [column[c].slice(lo, hi - lo).to_numpy(zero_copy_only=False) for c in ("_a", "_b")]
                for rows, size, x, y in cut(edges, *ends):
                    take = pa.array(rows + lo)
                    made = {"line_id": column["line_id"].take(take), key: column[key].take(take), "pts": points(size, x, y)}
                    if length:
                        made["length"] = pa.array(lengths(size, x, y))
                    yield pa.RecordBatch.from_arrays(list(made.values()), list(made))

    return run
