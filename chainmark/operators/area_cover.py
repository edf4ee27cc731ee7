"""A quadtree over the rings of all areas, for points inside any of them.

Cells without ring edges are inside (no test) or outside (no row). Cells with edges hold those edges and whether
their reference position is inside; a point crosses to that position along one level and one upright step, and
only edges of its cell can lie in between. Crowded cells are split eight by eight where that thins them out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.operators.scale import BROADCAST_BYTES, lookup_join, row_bytes, shuffled
from chainmark.session import checkpointed

#: Edges of a cell above which it is split, and the most rounds of splits.
CELL_RING_EDGES, SPLITS = 128, 7
#: How many times as long the lists of a cell's parts may become, over all splits together.
LISTED = 16
#: Bits of one split, and where in its cell a reference position lies (off any usual grid of coordinates).
BITS, REF_X, REF_Y = 3, 0.41421356237, 0.41735061089
_EDGE = ("x1", "y1", "x2", "y2")


@dataclass(frozen=True)
class Frame:
    """The square that holds all rings; its own reference position lies left of and below them, so outside."""

    x: float
    y: float
    size: float

    def index(self, x: Column, y: Column, depth: Column) -> tuple[Column, Column]:
        parts = F.pow(F.lit(2.0), depth)
        return tuple(F.floor((v - F.lit(o)) / F.lit(self.size) * parts).cast("long") for v, o in ((x, self.x), (y, self.y)))

    def reference(self, cx: Column, cy: Column, depth: Column) -> tuple[Column, Column]:
        side = F.lit(self.size) / F.pow(F.lit(2.0), depth)
        return F.lit(self.x) + (cx + F.lit(REF_X)) * side, F.lit(self.y) + (cy + F.lit(REF_Y)) * side

    def touches(self, e, cx: Column, cy: Column, depth: Column) -> Column:
        """Whether an edge meets a cell; a cell is taken wider by what coordinates are rounded to."""
        side = F.lit(self.size) / F.pow(F.lit(2.0), depth)
        half = side / 2 * (1 + 1e-9) + 1e-12 * (abs(self.x) + abs(self.y) + self.size)
        mx, my = F.lit(self.x) + (cx + F.lit(0.5)) * side, F.lit(self.y) + (cy + F.lit(0.5)) * side
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        boxes = (F.least(e["x1"], e["x2"]) <= mx + half) & (F.greatest(e["x1"], e["x2"]) >= mx - half) \
            & (F.least(e["y1"], e["y2"]) <= my + half) & (F.greatest(e["y1"], e["y2"]) >= my - half)
        beside = F.abs(dx * (my - e["y1"]) - dy * (mx - e["x1"])) <= half * (F.abs(dx) + F.abs(dy)) * (1 + 1e-9)
        return boxes & beside


def ring_edges(areas: DataFrame, area: str) -> DataFrame:
    """Edges of all rings of polygons in column ``rings``; an open ring is closed."""
    rings = areas.select(area, F.explode("rings").alias("ring")).where(F.size("ring") > 2)
    first, last = F.element_at("ring", 1), F.element_at("ring", -1)
    rings = rings.withColumn("ring", F.when(first == last, F.col("ring")).otherwise(F.concat("ring", F.array(first))))
    legs = F.zip_with(F.slice("ring", F.lit(1), F.size("ring") - 1), F.slice("ring", F.lit(2), F.size("ring") - 1),
                      lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    return rings.select(area, F.explode(legs).alias("e")).select(area, "e.*")


def _right_of(e, y: Column) -> Column:
    """Where an edge is at height ``y``, as the crossing count takes it."""
    rise = F.when(e["y1"] == e["y2"], F.lit(1.0)).otherwise(e["y2"] - e["y1"])
    return e["x1"] + (y - e["y1"]) / rise * (e["x2"] - e["x1"])


def toggles(e, x: Column, y: Column, rx: Column, ry: Column) -> Column:
    """Whether an edge lies between a position and ``(rx, ry)``, by way of ``(rx, y)``: once, not twice.

    Both steps use the side of one formula, so the parity of all edges is that of the crossing count to the right,
    half-open in y.
    """
    spans = (e["y1"] > y) != (e["y2"] > y)
    level = spans & ((x < _right_of(e, y)) != (rx < _right_of(e, y)))
    low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    foot = F.when(e["y1"] <= e["y2"], e["x1"]).otherwise(e["x2"])

    def above(h: Column) -> Column:
        return (h >= high) | ((h >= low) & ((rx < _right_of(e, h)) != (rx < foot)))

    upright = ((e["x1"] > rx) != (e["x2"] > rx)) & (above(y) != above(ry))
    return level != upright


def _cols() -> dict[str, Column]:
    return {c: F.col(c) for c in _EDGE}


def cover(areas: DataFrame, area: str = "area_id", cell_edges: int = CELL_RING_EDGES, rounds: int = SPLITS) -> tuple[Frame, dict[int, DataFrame], DataFrame] | None:
    """The frame, split cells ``(_d, _cx, _cy)`` by depth and end cells ``(_d, _cx, _cy, _base, _ring)``; None without edges.

    A cell is split while it holds more than ``cell_edges`` edges and the lists of all its parts, and parts of parts, are
    at most ``LISTED`` times as long as the edges they come from. Parts inside some area need no edges and do not count,
    so that areas piled on each other are split along the rim of the pile. Long parallel edges, which splits would only
    list again, stay in one cell, one row for each area; so do edges that still lie together after all ``rounds``.
    An end cell inside some area needs no other area. Areas with a null id or with a vertex that is not finite cover nothing.
    """
    inf = F.lit(float("inf"))
    whole = F.forall("rings", lambda r: F.forall(r, lambda p: F.coalesce((F.abs(p["x"]) < inf) & (F.abs(p["y"]) < inf), F.lit(False))))
    edges = checkpointed(ring_edges(areas.where(F.col(area).isNotNull() & whole), area).withColumnRenamed(area, "_area"))
    found = edges.agg(*[f(g(F.col(a), F.col(b))).alias(n) for n, f, g, a, b in (
        ("left", F.min, F.least, "x1", "x2"), ("right", F.max, F.greatest, "x1", "x2"),
        ("low", F.min, F.least, "y1", "y2"), ("high", F.max, F.greatest, "y1", "y2"))], F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return None
    size = 2.0 * max(found["right"] - found["left"], found["high"] - found["low"]) or 1.0
    frame = Frame(found["left"] - 0.45 * size, found["low"] - 0.45 * size, size)
    cell = ["_cx", "_cy"]
    zero = F.lit(0).cast("long")
    work = edges.select("_area", *_EDGE, zero.alias("_cx"), zero.alias("_cy"), F.lit(found["n"]).cast("long").alias("_n"), F.lit(0).alias("_base"), F.lit(1.0).alias("_times"))
    splits, ends, depth, crowded = {}, [], 0, found["n"] > cell_edges
    while crowded and depth < rounds * BITS:
        here, below = F.lit(depth), F.lit(depth + BITS)
        ways = 1 << BITS
        kids = work.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(ways * ways - 1)))).withColumns({
            "_kx": F.col("_cx") * ways + F.col("_j") % ways, "_ky": F.col("_cy") * ways + F.floor(F.col("_j") / ways)})
        kids = kids.withColumn("_touch", frame.touches(_cols(), F.col("_kx"), F.col("_ky"), below))
        flips = toggles(_cols(), *frame.reference(F.col("_kx"), F.col("_ky"), below), *frame.reference(F.col("_cx"), F.col("_cy"), here))
        counts = checkpointed(kids.groupBy("_kx", "_ky", "_area").agg(
            F.first("_cx").alias("_cx"), F.first("_cy").alias("_cy"), F.max("_n").alias("_n"), F.max("_times").alias("_times"), F.sum(F.col("_touch").cast("long")).alias("_held"),
            ((F.max("_base") + F.sum(flips.cast("long"))) % 2).cast("int").alias("_kbase")).where("_held > 0 or _kbase = 1"))
        parts = counts.groupBy("_kx", "_ky", *cell).agg(
            F.max("_n").alias("_n"), F.max("_times").alias("_was"), F.sum("_held").alias("_held"), F.max((F.col("_held") == 0) & (F.col("_kbase") == 1)).alias("_inner"))
        left = F.when(F.col("_inner"), 0).otherwise(F.col("_held"))  # a part inside an area needs no edges
        times = F.sum(left) * F.max("_was") / F.max("_n")
        worth = parts.groupBy(*cell).agg(times.alias("_times"), (times <= LISTED).alias("_pays"))
        judged = checkpointed(parts.join(shuffled(worth), cell))
        splits[depth] = judged.where("_pays").select(*cell).distinct().select(here.alias("_d"), *cell)
        crowded = not judged.where(f"_pays and not _inner and _held > {cell_edges}").isEmpty()
        stay = judged.where("not _pays").select(*cell).distinct()
        ends.append(_end_rows(work.join(shuffled(stay), cell, "left_semi"), depth))
        inner = judged.where("_pays and _inner").select("_kx", "_ky")
        ends.append(inner.select(below.alias("_d"), F.col("_kx").alias("_cx"), F.col("_ky").alias("_cy"), F.lit(1).alias("_base"),
                                 F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("_ring")))
        open_cells = judged.where("_pays and not _inner and _held > 0").select("_kx", "_ky", F.col("_held").alias("_total"), "_times")
        named = counts.where("_held > 0").drop("_times").join(shuffled(open_cells), ["_kx", "_ky"]).select("_kx", "_ky", "_area", "_kbase", "_total", "_times")
        kept = kids.where("_touch").select("_area", *_EDGE, "_kx", "_ky").join(shuffled(named), ["_kx", "_ky", "_area"]).select(
            "_area", *_EDGE, F.col("_kx").alias("_cx"), F.col("_ky").alias("_cy"), F.col("_total").alias("_n"), F.col("_kbase").alias("_base"), "_times")
        depth += BITS
        if crowded and depth < rounds * BITS:
            kept = checkpointed(kept)
            ends.append(_end_rows(kept.where(F.col("_n") <= cell_edges), depth))
            kept = kept.where(F.col("_n") > cell_edges)
        work = kept
    ends.append(_end_rows(work, depth))
    return frame, splits, checkpointed(reduce(DataFrame.unionByName, ends))


def _end_rows(work: DataFrame, depth: int) -> DataFrame:
    return work.groupBy("_cx", "_cy", "_area", "_base").agg(F.collect_list(F.struct(*_EDGE)).alias("_ring")).select(
        F.lit(depth).alias("_d"), "_cx", "_cy", "_base", "_ring")


def inside_any(points: DataFrame, covered: tuple[Frame, dict[int, DataFrame], DataFrame], x: Column, y: Column) -> DataFrame:
    """Points with finite ``x`` and ``y`` inside any covered area, each once; split cells are looked up from the top."""
    frame, splits, ends = covered
    key = ["_d", "_cx", "_cy"]

    def placed(df: DataFrame, depth: Column) -> DataFrame:
        df = df.withColumn("_d", depth)
        cx, cy = frame.index(F.col("_px"), F.col("_py"), F.col("_d"))
        return df.withColumns({"_cx": cx, "_cy": cy})

    celled = placed(points.withColumns({"_px": x, "_py": y}), F.lit(0))
    if splits:
        # Upper levels go into one table, broadcast once for all lookups below the first; a level too large for it is looked up by itself.
        levels = checkpointed(reduce(DataFrame.unionByName, splits.values()).withColumn("_split", F.lit(BITS)))
        sizes = {r["_d"]: r["b"] for r in levels.groupBy("_d").agg(F.sum(row_bytes(levels)).alias("b")).collect()}
        upper = [d for d in splits if sum(sizes.get(u, 0) for u in splits if u <= d) <= BROADCAST_BYTES]
        table = levels.where(F.col("_d").isin(upper))
        for depth in splits:
            if depth in upper:
                joined = lookup_join(celled, table, key, dim_bytes=0)
            else:  # a shuffle join reads its large side twice
                joined = lookup_join(checkpointed(celled), levels.where(F.col("_d") == depth), key, dim_bytes=sizes[depth])
            celled = placed(joined, F.col("_d") + F.coalesce("_split", F.lit(0))).drop("_split")
    ref = frame.reference(F.col("_cx"), F.col("_cy"), F.col("_d"))
    crossed = F.size(F.filter("_ring", lambda e: toggles(e, F.col("_px"), F.col("_py"), *ref)))
    return lookup_join(celled, ends, key, (F.col("_base") + crossed) % 2 == 1, "left_semi").drop(*key, "_px", "_py")
