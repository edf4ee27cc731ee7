"""Lines cut where they meet: crossings, joints at vertices and overlaps, found through a grid that is split where it is crowded.

Coordinates are taken on a grid of ``10 ** -digits`` and compared as whole numbers, so whether a position lies left of,
right of or on an edge is decided exactly: in floating point where that is sure, else in decimals. Coordinates times
``10 ** digits`` must be below 1e16. A position of a crossing is rounded to the grid once for both lines.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.functions.geometry import point
from chainmark.operators.linear import cut_lines, line_totals
from chainmark.operators.scale import lookup_join, shuffled
from chainmark.session import checkpointed

#: Cells with more edges than this are split, unless few of them can cross.
CELL_EDGES = 64
#: How often a cell is split, each time into 16. Where more edges than ``CELL_EDGES`` cross within the smallest cells, and not
#: at a vertex that they share, they are compared in pairs there.
SPLITS = 5
_CELL = ["level", "cx", "cy"]


def on_grid(edges: DataFrame, digits: int) -> DataFrame:
    """Whole-number ends ``ax, ay, bx, by`` of each edge; edges without length on the grid are left out."""
    unit = F.lit(float(10 ** digits))
    names = {"ax": "x1", "ay": "y1", "bx": "x2", "by": "y2"}
    on = edges.select("line_id", "seq", "m0", "m1", *[F.round(F.col(c) * unit).cast("long").alias(n) for n, c in names.items()])
    return on.where((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")))


def _difference(p: Column, q: Column, r: Column) -> tuple[Column, Column, Column, Column]:
    return q["x"] - p["x"], r["y"] - p["y"], q["y"] - p["y"], r["x"] - p["x"]


def area(p: Column, q: Column, r: Column) -> Column:
    """Twice the signed area of p, q, r in floating point."""
    a, b, c, d = (v.cast("double") for v in _difference(p, q, r))
    return a * b - c * d


def side(p: Column, q: Column, r: Column) -> Column:
    """1, 0 or -1 as r lies left of, on or right of the line from p to q; exact."""
    a, b, c, d = (v.cast("double") for v in _difference(p, q, r))
    e, f, g, h = (v.cast("decimal(18,0)") for v in _difference(p, q, r))
    sure = F.abs(a * b - c * d) > (F.abs(a * b) + F.abs(c * d)) * 4e-16
    left, right = e * f, g * h
    return F.when(sure, F.signum(a * b - c * d).cast("int")).when(left > right, 1).when(left < right, -1).otherwise(0)


def xy(x: str | Column, y: str | Column) -> Column:
    return F.struct((F.col(x) if isinstance(x, str) else x).alias("x"), (F.col(y) if isinstance(y, str) else y).alias("y"))


def _cell(v: Column, bits: int) -> Column:
    return F.shiftright(v, bits)


def in_cells(edges: DataFrame, bits: int, level: int) -> DataFrame:
    """Each edge once for every cell of ``2 ** bits`` units that it comes within two units of: column by column, the rows it spans there."""
    size = 1 << bits
    low, high = F.least("ax", "bx"), F.greatest("ax", "bx")
    columns = edges.withColumn("cx", F.explode(F.sequence(_cell(low - 2, bits), _cell(high + 2, bits))))
    rise = (F.col("by") - F.col("ay")).cast("double") / F.greatest(F.abs(F.col("bx") - F.col("ax")), F.lit(1)).cast("double")
    rise = F.when(F.col("bx") >= F.col("ax"), rise).otherwise(-rise)

    def height(x: Column) -> Column:
        return F.col("ay") + rise * (x - F.col("ax")).cast("double")

    left, right = F.greatest(F.col("cx") * size - 2, low), F.least((F.col("cx") + 1) * size + 2, high)
    upright = F.col("ax") == F.col("bx")
    ends = F.least("ay", "by"), F.greatest("ay", "by")
    at = height(left), height(right)
    bottom = F.when(upright, ends[0]).otherwise(F.greatest(F.floor(F.least(*at)), ends[0]))
    top = F.when(upright, ends[1]).otherwise(F.least(F.ceil(F.greatest(*at)), ends[1]))
    rows = columns.withColumn("cy", F.explode(F.sequence(_cell(bottom - 2, bits), _cell(top + 2, bits))))
    return rows.withColumn("level", F.lit(level))


def _spots_of(edges: DataFrame) -> DataFrame:
    """Distinct positions of vertices."""
    return edges.select(F.explode(F.array(xy("ax", "ay"), xy("bx", "by"))).alias("p")).select("p.x", "p.y").distinct()


def _placed(spots: DataFrame, bits: int, level: int) -> DataFrame:
    return spots.select("x", "y", F.lit(level).alias("level"), _cell(F.col("x"), bits).alias("cx"), _cell(F.col("y"), bits).alias("cy"))


def _leaves(edges: DataFrame, bits: int, cell_edges: int) -> tuple[DataFrame, DataFrame]:
    """Edges and vertex positions in the cells of a grid, crowded cells split into 16 again and again.

    In a cell with many edges most of them may share one vertex, its hub; edges that share a vertex do not cross beside it,
    so only the others are compared, with all. A cell is crowded if it has more than ``cell_edges`` edges, and more others
    and vertex positions together than that. ``hub_x, hub_y`` are null in cells with few edges.
    """
    spots, level, last = checkpointed(_spots_of(edges)), 0, max(4, bits - 2 * SPLITS)
    listed, placed = checkpointed(in_cells(edges, bits, 0)), _placed(spots, bits, 0)
    done_edges, done_spots = [], []
    while True:
        many = listed.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("edges")).where(F.col("edges") > cell_edges)
        many = checkpointed(many)
        if many.limit(1).count() == 0:
            break
        inside = lookup_join(listed, many, _CELL, how="inner")
        ends = inside.select(*_CELL, F.explode(F.array(xy("ax", "ay"), xy("bx", "by"))).alias("hub"))
        counts = ends.groupBy(*_CELL, "hub").agg(F.count(F.lit(1)).alias("n"))
        hubs = counts.groupBy(*_CELL).agg(F.max(F.struct("n", "hub")).alias("h")).select(*_CELL, F.col("h.n").alias("spokes"), "h.hub")
        held = lookup_join(placed, many.drop("edges"), _CELL, how="inner").groupBy(*_CELL).agg(F.count(F.lit(1)).alias("spots"))
        judged = many.join(shuffled(hubs), _CELL).join(shuffled(held), _CELL, "left")
        busy = (F.col("edges") - F.col("spokes") + F.coalesce("spots", F.lit(0))) > cell_edges
        judged = checkpointed(judged.select(*_CELL, "hub", busy.alias("busy")))
        marks = judged.select(*_CELL, F.col("hub.x").alias("hub_x"), F.col("hub.y").alias("hub_y"), (F.col("busy") & F.lit(bits > last)).alias("split"))
        listed, placed = checkpointed(lookup_join(listed, marks, _CELL)), checkpointed(lookup_join(placed, marks.select(*_CELL, "split"), _CELL))
        split = F.coalesce("split", F.lit(False))
        done_edges.append(listed.where(~split))
        done_spots.append(placed.where(~split).drop("split"))
        down = listed.where("split").withColumnsRenamed({"cx": "ux", "cy": "uy"})
        below = placed.where("split").select("x", "y")
        bits, level = bits - 2, level + 1
        finer = in_cells(down, bits, level).where((F.shiftright("cx", 2) == F.col("ux")) & (F.shiftright("cy", 2) == F.col("uy"))).drop("ux", "uy")
        listed, placed = checkpointed(finer.select(*edges.columns, *_CELL)), checkpointed(_placed(below, bits, level))
    none = F.lit(None).cast("long")
    done_edges.append(listed.withColumns({"hub_x": none, "hub_y": none}))
    done_spots.append(placed)
    columns = [*edges.columns, *_CELL, "hub_x", "hub_y"]
    return reduce(DataFrame.unionByName, [d.select(columns) for d in done_edges]), reduce(DataFrame.unionByName, done_spots)


def _touches(edges: DataFrame, spots: DataFrame) -> DataFrame:
    """Vertex positions on edges, their own ends included: ``(line_id, measure, x, y)``, once for each edge."""
    p, q, r = xy("ax", "ay"), xy("bx", "by"), xy("x", "y")
    within = (F.col("x").between(F.least("ax", "bx"), F.greatest("ax", "bx"))) & (F.col("y").between(F.least("ay", "by"), F.greatest("ay", "by")))
    met = edges.join(shuffled(spots), _CELL).where(within & (side(p, q, r) == 0))
    dx, dy = (F.col("bx") - F.col("ax")).cast("double"), (F.col("by") - F.col("ay")).cast("double")
    share = ((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy) / (dx * dx + dy * dy)
    measure = F.when(r == p, F.col("m0")).when(r == q, F.col("m1")).otherwise(F.col("m0") + share * (F.col("m1") - F.col("m0")))
    return met.select("line_id", measure.alias("measure"), "x", "y")


def _once(rows: DataFrame, unit: float) -> DataFrame:
    """Measures of a line at a position, without those that say the same: two edges that share a vertex both report it."""
    lists = rows.groupBy("line_id", "x", "y").agg(F.sort_array(F.collect_set("measure")).alias("m"))
    return lists.withColumn("m", F.filter("m", lambda v, i: (i == 0) | (v - F.get("m", i - 1) > 1.5 * unit)))


def _crossed(edges: DataFrame, bits: int) -> DataFrame:
    """Positions inside two edges where they cross: ``(line_id, measure, x, y)`` for both."""
    key = F.struct("line_id", "seq")
    spoke = F.coalesce(((F.col("ax") == F.col("hub_x")) & (F.col("ay") == F.col("hub_y"))) | ((F.col("bx") == F.col("hub_x")) & (F.col("by") == F.col("hub_y"))), F.lit(False))
    packed = edges.select(*_CELL, spoke.alias("spoke"), F.struct(key.alias("key"), xy("ax", "ay").alias("p"), xy("bx", "by").alias("q"), "m0", "m1").alias("e"))
    others = packed.where(~F.col("spoke")).select(*_CELL, F.col("e").alias("f"))
    pairs = packed.join(shuffled(others), _CELL).where(F.col("spoke") | (F.col("e.key") < F.col("f.key")))
    first = F.col("e.key") < F.col("f.key")
    pairs = pairs.select(*_CELL, F.when(first, F.col("e")).otherwise(F.col("f")).alias("e"), F.when(first, F.col("f")).otherwise(F.col("e")).alias("f"))
    e, f = F.col("e"), F.col("f")
    boxes = reduce(lambda a, b: a & b, [
        (F.least(e["p"][c], e["q"][c]) <= F.greatest(f["p"][c], f["q"][c])) & (F.least(f["p"][c], f["q"][c]) <= F.greatest(e["p"][c], e["q"][c])) for c in ("x", "y")])
    pairs = pairs.where(boxes).where((side(e["p"], e["q"], f["p"]) * side(e["p"], e["q"], f["q"]) < 0) & (side(f["p"], f["q"], e["p"]) * side(f["p"], f["q"], e["q"]) < 0))

    def share(of: Column, by: Column) -> Column:
        here, there = area(by["p"], by["q"], of["p"]), area(by["p"], by["q"], of["q"])
        return F.least(F.greatest(here / F.nullif(here - there, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))

    pairs = pairs.withColumns({"s": F.coalesce(share(e, f), F.lit(0.5)), "t": F.coalesce(share(f, e), F.lit(0.5))})
    place = {c: F.round(e["p"][c] + F.col("s") * (e["q"][c] - e["p"][c])).cast("long") for c in ("x", "y")}
    pairs = pairs.withColumns(place)
    here = (F.expr(f"shiftright(x, {bits} - 2 * level)") == F.col("cx")) & (F.expr(f"shiftright(y, {bits} - 2 * level)") == F.col("cy"))
    both = F.array(*[F.struct(g["key"]["line_id"].alias("line_id"), (g["m0"] + F.col(k) * (g["m1"] - g["m0"])).alias("measure")) for g, k in ((e, "s"), (f, "t"))])
    return pairs.where(here).select("x", "y", F.explode(both).alias("r")).select("r.line_id", "r.measure", "x", "y")


def crossings(edges: DataFrame, digits: int = 6, cell_edges: int = CELL_EDGES, cell_size: float | None = None) -> DataFrame:
    """Where lines meet each other or themselves: ``(line_id, measure, x, y)``, once for each time a line passes there.

    ``edges`` is an edge table. Edges that cross inside both, vertices on edges, shared vertices, and the ends of overlaps
    count; the joint of two neighbouring edges of one line does not. Ends of lines are reported where something else is.
    Cells are a few mean edge lengths wide (``cell_size``), to a power of four of the grid.
    """
    unit = 10.0 ** -digits
    grid = checkpointed(on_grid(edges, digits))
    if cell_size is None:
        cell_size = 4 * (grid.agg(F.avg(F.col("m1") - F.col("m0"))).first()[0] or 1.0)
    bits = 2 * max(2, math.ceil(math.log(max(cell_size / unit, 16.0), 4)))
    listed, spots = _leaves(grid, bits, cell_edges)
    listed = checkpointed(listed)
    visits = checkpointed(_once(_touches(listed, spots), unit))
    busy = visits.groupBy("x", "y").agg(F.sum(F.size("m")).alias("visits")).where("visits > 1").select("x", "y", F.lit(True).alias("_busy"))
    touched = lookup_join(visits, busy, ["x", "y"], how="inner").select("line_id", F.explode("m").alias("measure"), "x", "y")
    every = _once(touched.unionByName(_crossed(listed, bits)), unit).select("line_id", F.explode("m").alias("measure"), "x", "y")
    return every.select("line_id", "measure", *[(F.col(c) / F.lit(float(10 ** digits))).alias(c) for c in ("x", "y")])


def split_at_crossings(edges: DataFrame, digits: int = 6, **options) -> DataFrame:
    """Pieces ``(line_id, piece, a, b, pts)`` of each line between the places where it meets another line or itself.

    Pieces that meet share the position to the last digit. Cuts within one and a half units of a line's end make no piece.
    """
    unit = 10.0 ** -digits
    cuts = lookup_join(crossings(edges, digits, **options), line_totals(edges), ["line_id"], how="inner")
    cuts = checkpointed(cuts.where((F.col("measure") > 1.5 * unit) & (F.col("measure") < F.col("length") - 1.5 * unit)).drop("length"))
    pieces = cut_lines(edges, cuts)
    places = cuts.groupBy("line_id", "measure").agg(F.min(F.struct("x", "y")).alias("p"))
    pieces = lookup_join(pieces, places.withColumnsRenamed({"measure": "a", "p": "_start"}), ["line_id", "a"])
    pieces = lookup_join(pieces, places.withColumnsRenamed({"measure": "b", "p": "_end"}), ["line_id", "b"])
    first, last = F.get("pts", F.lit(0)), F.element_at("pts", -1)
    ends = F.array(F.coalesce(point(F.col("_start.x"), F.col("_start.y")), first)), F.array(F.coalesce(point(F.col("_end.x"), F.col("_end.y")), last))
    middle = F.slice("pts", F.lit(2), F.greatest(F.size("pts") - 2, F.lit(0)))
    return pieces.select("line_id", "piece", "a", "b", F.concat(ends[0], middle, ends[1]).alias("pts"))
