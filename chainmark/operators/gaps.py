"""Line ends that nearly meet: bridged to each other by mutually nearest rounds, or extended to the first edge ahead.

An end dangles if no other end lies at its place; three ends at one place, and the two of a ring, do not.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainmark.functions.geometry import point
from chainmark.operators.linear import edge_table
from chainmark.operators.noding import area, in_cells, on_grid, side, xy
from chainmark.operators.scale import lookup_join, shuffled
from chainmark.session import checkpointed

#: Where a cell holds more ends than this, the search begins with a smaller radius, down to 4 ** -STEPS of the tolerance.
CELL_ENDS, STEPS = 32, 10
#: Cells with more pairs of a ray and an edge than this are split into 16, up to this often.
CELL_PAIRS, SPLITS = 4096, 5
_CELL = ["level", "cx", "cy"]
_CUTS = "array<struct<n:bigint,m:double,p:struct<x:double,y:double>>>"


def dangling_ends(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, id, far, x, y)``: ends of the parts ``(id, *keys, pts)`` at whose place no other end with equal keys lies.

    ``far`` is true for the last vertex. Parts without vertices, and with null ids, are left out.
    """
    first, last = F.get("pts", F.lit(0)), F.element_at("pts", -1)
    some = parts.where((F.size("pts") > 0) & F.col("id").isNotNull())
    both = F.array(*[F.struct(F.lit(far).alias("far"), p["x"].alias("x"), p["y"].alias("y")) for far, p in ((False, first), (True, last))])
    ends = some.select("id", *keys, F.explode(both).alias("e")).select("id", *keys, "e.*")
    meet = ends.groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "far")).alias("e"))
    return meet.where("n = 1").select(*keys, "e.id", "e.far", "x", "y")


def _near_pairs(ends: DataFrame, radius: float, keys: Sequence[str]) -> DataFrame:
    """Pairs ``(rank)`` of ends of different parts within the radius; ranks order all pairs."""
    size = F.lit(radius * 1.001)  # wider than the radius, so that rounding hides no neighbour
    packed = ends.select(*keys, F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy"),
                         F.struct(F.struct("id", "far").alias("end"), "x", "y").alias("e"))
    ahead = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ahead])).alias("s")
    asked = packed.select("*", steps).select(*keys, (F.col("cx") + F.col("s.a")).alias("cx"), (F.col("cy") + F.col("s.b")).alias("cy"),
                                             F.col("e").alias("f"), ((F.col("s.a") == 0) & (F.col("s.b") == 0)).alias("same"))
    met = packed.join(shuffled(asked), [*keys, "cx", "cy"]).where((F.col("e.end.id") != F.col("f.end.id")) & (~F.col("same") | (F.col("e.end") < F.col("f.end"))))
    dx, dy = F.col("e.x") - F.col("f.x"), F.col("e.y") - F.col("f.y")
    low, high = F.least("e", "f"), F.greatest("e", "f")
    near = met.select((dx * dx + dy * dy).alias("square"), low.alias("e"), high.alias("f")).where(F.col("square") <= radius * radius)
    # Evenly spaced ends are all equally far apart; in the order of a digest few of them wait for each other.
    tie = F.md5(F.concat_ws("|", "e.end.id", "e.end.far", "f.end.id", "f.end.far"))
    return near.select(F.struct("square", tie.alias("tie"), "e", "f").alias("rank"))


def gaps(parts: DataFrame, tolerance: float, keys: Sequence[str] = ()) -> DataFrame:
    """Gaps to bridge: ``(id, far, x, y, other, other_far, other_x, other_y, gap)``, each dangling end in one at most.

    Of all pairs of dangling ends of different parts within the tolerance, the nearest is taken, its ends are used up, and
    so on; equally far pairs go in the order of a digest of their names. A round takes every pair that is the nearest of both
    its ends, so there are as many rounds as the longest chain of ends that each wait for a nearer pair.

    Where ends crowd, small radii go first: what is left then lies at least a radius apart, so cells of the doubled radius hold few.
    """
    if tolerance <= 0:
        raise ValueError("the tolerance must be positive")
    open_ = checkpointed(dangling_ends(parts, keys))
    radius = tolerance
    for _ in range(STEPS):
        cells = open_.groupBy(*keys, F.floor(F.col("x") / radius), F.floor(F.col("y") / radius)).count()
        if (cells.agg(F.max("count")).first()[0] or 0) <= CELL_ENDS:
            break
        radius /= 4
    taken = []
    while True:
        pairs, here = checkpointed(_near_pairs(open_, radius, keys)), []
        while True:
            best = pairs.select("rank", F.explode(F.array("rank.e.end", "rank.f.end")).alias("end")).groupBy("end").agg(F.min("rank").alias("rank"))
            mutual = checkpointed(best.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("rank"))
            if mutual.limit(1).count() == 0:
                break
            here.append(mutual)
            used = checkpointed(mutual.select(F.explode(F.array("rank.e.end", "rank.f.end")).alias("end")))
            left = pairs.select("rank", F.col("rank.e.end").alias("e"), F.col("rank.f.end").alias("f"))
            left = lookup_join(left, used.withColumnRenamed("end", "e"), ["e"], how="left_anti")
            left = lookup_join(left, used.withColumnRenamed("end", "f"), ["f"], how="left_anti")
            pairs = checkpointed(left.select("rank"))
        taken += here
        if radius >= tolerance:
            break
        if here:
            used = reduce(DataFrame.unionByName, here).select(F.explode(F.array("rank.e.end", "rank.f.end")).alias("u")).select("u.id", "u.far")
            open_ = checkpointed(lookup_join(open_, checkpointed(used), ["id", "far"], how="left_anti"))
        radius = min(2 * radius, tolerance)
    every = reduce(DataFrame.unionByName, taken) if taken else pairs.limit(0)
    e, f = F.col("rank.e"), F.col("rank.f")
    return every.select(e["end"]["id"].alias("id"), e["end"]["far"].alias("far"), e["x"].alias("x"), e["y"].alias("y"),
                        f["end"]["id"].alias("other"), f["end"]["far"].alias("other_far"), f["x"].alias("other_x"), f["y"].alias("other_y"),
                        F.sqrt("rank.square").alias("gap"))


def _with_ends(parts: DataFrame, moves: DataFrame) -> DataFrame:
    """Parts with the positions of ``(id, far, p)`` put before their first or after their last vertex."""
    both = moves.groupBy("id").agg(F.max(F.when(~F.col("far"), F.col("p"))).alias("_head"), F.max(F.when(F.col("far"), F.col("p"))).alias("_tail"))
    joined = lookup_join(parts, checkpointed(both), ["id"])
    ends = [F.when(F.col(c).isNotNull(), F.array(c)).otherwise(F.slice("pts", 1, 0)) for c in ("_head", "_tail")]
    return joined.withColumn("pts", F.concat(ends[0], "pts", ends[1])).select(*parts.columns)


def close_gaps(parts: DataFrame, tolerance: float, keys: Sequence[str] = ()) -> DataFrame:
    """The parts, the smaller end of each gap drawn to the place of the other, so that two ends meet there; see ``gaps``."""
    found = gaps(parts, tolerance, keys)
    return _with_ends(parts, found.select("id", "far", point(F.col("other_x"), F.col("other_y")).alias("p")))


def _rays(grid: DataFrame, tolerance: float, digits: int) -> DataFrame:
    """Rays ``(id, own, far, ax, ay, bx, by)`` from the dangling ends of lines, on along their last edges as far as the tolerance."""
    names = ["seq", "ax", "ay", "bx", "by"]
    outer = grid.groupBy("line_id").agg(F.min(F.struct(*names)).alias("h"), F.max(F.struct(*names)).alias("t"))
    h, t = F.col("h"), F.col("t")
    head = F.struct(F.lit(False).alias("far"), h["seq"].alias("own"), h["ax"].alias("ax"), h["ay"].alias("ay"), h["bx"].alias("px"), h["by"].alias("py"))
    tail = F.struct(F.lit(True).alias("far"), t["seq"].alias("own"), t["bx"].alias("ax"), t["by"].alias("ay"), t["ax"].alias("px"), t["ay"].alias("py"))
    ends = outer.select(F.col("line_id").alias("id"), F.explode(F.array(head, tail)).alias("e")).select("id", "e.*")
    meet = ends.groupBy("ax", "ay").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "far", "own", "px", "py")).alias("e"))
    single = meet.where("n = 1").select("e.id", "e.own", "e.far", "ax", "ay", "e.px", "e.py")
    dx, dy = (F.col("ax") - F.col("px")).cast("double"), (F.col("ay") - F.col("py")).cast("double")
    reach = F.lit(tolerance * float(10 ** digits))
    on = {n: F.col(a) + F.round(reach * d / F.sqrt(dx * dx + dy * dy)).cast("long") for n, a, d in (("bx", "ax", dx), ("by", "ay", dy))}
    return single.withColumns(on).drop("px", "py")


def _meeting_cells(edges: DataFrame, rays: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Edges and rays in the cells that hold both; cells with many pairs are split into 16 again and again."""
    level, last, sides = 0, max(4, bits - 2 * SPLITS), {"edges": edges, "rays": rays}
    listed = {n: in_cells(d, bits, 0) for n, d in sides.items()}
    done: dict[str, list[DataFrame]] = {"edges": [], "rays": []}
    while True:
        asked = checkpointed(listed["rays"].groupBy(*_CELL).agg(F.count(F.lit(1)).alias("n_rays")))
        inside = checkpointed(lookup_join(listed["edges"], asked, _CELL, how="inner"))
        counts = inside.groupBy(*_CELL).agg((F.count(F.lit(1)) * F.max("n_rays") > CELL_PAIRS).alias("many"))
        marks = checkpointed(counts.select(*_CELL, (F.col("many") & F.lit(bits > last)).alias("split")))
        here = {"edges": inside.drop("n_rays"), "rays": listed["rays"]}
        here = {n: checkpointed(lookup_join(d, marks, _CELL, how="inner")) for n, d in here.items()}
        for n, d in here.items():
            done[n].append(d.where(~F.col("split")).drop("split"))
        if marks.where("split").limit(1).count() == 0:
            break
        bits, level = bits - 2, level + 1
        for n, d in here.items():
            finer = in_cells(d.where("split").withColumnsRenamed({"cx": "ux", "cy": "uy"}), bits, level)
            finer = finer.where((F.shiftright("cx", 2) == F.col("ux")) & (F.shiftright("cy", 2) == F.col("uy")))
            listed[n] = finer.select(*sides[n].columns, *_CELL)
    both = {n: reduce(DataFrame.unionByName, [d.select(*sides[n].columns, *_CELL) for d in done[n]]) for n in done}
    return both["edges"], both["rays"]


def end_extensions(edges: DataFrame, tolerance: float, digits: int = 6, cell_size: float | None = None) -> DataFrame:
    """Where dangling ends meet an edge ahead: ``(line_id, far, x, y, onto, onto_seq, onto_measure, hit_x, hit_y, reach)``, once for each end that does.

    ``edges`` is an edge table. An end is extended along its last edge, as far as the tolerance and to the first edge on the
    way; an edge that runs along the ray is hit at its nearer end; of edges hit at one place the smallest (line, number) is
    named. The own last edge is not hit, other edges of the own line are. An end that lies on another edge is joined already,
    and rays do not meet rays. Coordinates are compared on a grid of ``10 ** -digits``, on which the ray ends too, with exact
    signs. Where many rays and edges meet in the smallest cells, they are compared in pairs there.
    """
    if tolerance <= 0:
        raise ValueError("the tolerance must be positive")
    unit = float(10 ** digits)
    grid = checkpointed(on_grid(edges, digits))
    rays = checkpointed(_rays(grid, tolerance, digits))
    if cell_size is None:
        cell_size = max(tolerance, grid.agg(F.avg(F.col("m1") - F.col("m0"))).first()[0] or 1.0)
    bits = 2 * max(2, math.ceil(math.log(max(cell_size * unit, 16.0), 4)))
    listed, asked = _meeting_cells(grid, rays, bits)
    a, b, p, q = xy("ax", "ay"), xy("bx", "by"), xy("px", "py"), xy("qx", "qy")
    named = listed.withColumnsRenamed({"ax": "px", "ay": "py", "bx": "qx", "by": "qy", "line_id": "onto", "seq": "onto_seq"})
    met = named.join(shuffled(asked), _CELL).where((F.col("onto") != F.col("id")) | (F.col("onto_seq") != F.col("own")))
    near = reduce(lambda u, v: u & v, [
        (F.least(f"a{c}", f"b{c}") <= F.greatest(f"p{c}", f"q{c}")) & (F.least(f"p{c}", f"q{c}") <= F.greatest(f"a{c}", f"b{c}")) for c in ("x", "y")])
    met = met.where(near).withColumns({"s_p": side(a, b, p), "s_q": side(a, b, q), "s_a": side(p, q, a), "s_b": side(p, q, b)})
    met = met.where((F.col("s_p") * F.col("s_q") <= 0) & (F.col("s_a") * F.col("s_b") <= 0))
    dx, dy = (F.col("bx") - F.col("ax")).cast("double"), (F.col("by") - F.col("ay")).cast("double")

    def along(c: str):
        return ((F.col(f"{c}x") - F.col("ax")) * dx + (F.col(f"{c}y") - F.col("ay")) * dy) / (dx * dx + dy * dy)

    here, there = area(p, q, a), area(p, q, b)
    share = F.when(F.col("s_a") == 0, 0.0).otherwise(F.least(F.greatest(F.coalesce(here / F.nullif(here - there, F.lit(0.0)), F.lit(0.5)), F.lit(0.0)), F.lit(1.0)))
    cross = F.struct(share.alias("t"), *[(F.col(f"a{c}") + F.round(share * d).cast("long")).alias(c) for c, d in (("x", dx), ("y", dy))])
    end = {c: F.struct(along(c).alias("t"), F.col(f"{c}x").alias("x"), F.col(f"{c}y").alias("y")) for c in ("p", "q")}
    start = F.struct(F.lit(0.0).alias("t"), F.col("ax").alias("x"), F.col("ay").alias("y"))
    flat = (F.col("s_p") == 0) & (F.col("s_q") == 0)
    # Boxes meet, so an edge along the ray has a part on it: from the nearer end, or from where the ray starts.
    first = F.when(F.least(end["p"]["t"], end["q"]["t"]) <= 0, start).otherwise(F.least(end["p"], end["q"]))
    hit = F.when(flat, first).when(F.col("s_a") == 0, start).when(F.col("s_p") == 0, end["p"]).when(F.col("s_q") == 0, end["q"]).otherwise(cross)
    ex, ey = (F.col("qx") - F.col("px")).cast("double"), (F.col("qy") - F.col("py")).cast("double")
    on_edge = ((F.col("h.x") - F.col("px")) * ex + (F.col("h.y") - F.col("py")) * ey) / (ex * ex + ey * ey)
    at_p, at_q = (F.col("h.x") == F.col("px")) & (F.col("h.y") == F.col("py")), (F.col("h.x") == F.col("qx")) & (F.col("h.y") == F.col("qy"))
    measure = F.when(at_p, F.col("m0")).when(at_q, F.col("m1")).otherwise(F.col("m0") + on_edge * (F.col("m1") - F.col("m0")))
    hits = met.withColumn("h", hit).select(
        "id", "far", "ax", "ay", (F.col("h.t") * F.sqrt(dx * dx + dy * dy) / unit).alias("reach"),
        F.struct(F.col("h.t").alias("t"), "onto", "onto_seq", measure.alias("onto_measure"), F.col("h.x").alias("x"), F.col("h.y").alias("y")).alias("h"))
    nearest = hits.groupBy("id", "far", "ax", "ay").agg(F.min(F.struct("h", "reach")).alias("m")).where("m.h.x <> ax or m.h.y <> ay")
    return nearest.select(F.col("id").alias("line_id"), "far", (F.col("ax") / unit).alias("x"), (F.col("ay") / unit).alias("y"), "m.h.onto", "m.h.onto_seq", "m.h.onto_measure",
                          (F.col("m.h.x") / unit).alias("hit_x"), (F.col("m.h.y") / unit).alias("hit_y"), "m.reach")


def extend_ends(lines: DataFrame, tolerance: float, digits: int = 6) -> DataFrame:
    """Lines ``(line_id, pts)`` with their ends extended as ``end_extensions`` says; each place hit is a vertex of the edge hit.

    Extended ends and edges hit then share a vertex to the last digit, so that ``noding.split_at_crossings`` cuts there.
    """
    edges = checkpointed(edge_table(lines))
    found = checkpointed(end_extensions(edges, tolerance, digits))
    place = point(F.col("hit_x"), F.col("hit_y"))
    cuts = found.select(F.col("onto").alias("line_id"), F.struct(F.col("onto_seq").alias("n"), F.col("onto_measure").alias("m"), place.alias("p")).alias("c"))
    cuts = checkpointed(cuts.groupBy("line_id").agg(F.collect_set("c").alias("_cuts")))
    own = F.transform("pts", lambda v, i: F.struct(i.cast("long").alias("n"), F.lit(-1.0).alias("m"), point(v["x"], v["y"]).alias("p")))
    cut = lookup_join(lines, cuts, ["line_id"])
    every = F.array_sort(F.concat(own, F.coalesce("_cuts", F.array().cast(_CUTS))))
    # A place hit that is a vertex already, or was hit twice, is there once.
    cut = cut.withColumn("_every", every)
    before, after = (lambda i: F.get("_every", i - 1)), (lambda i: F.get("_every", i + 1))
    new = F.filter("_every", lambda v, i: (v["m"] < 0) | ((v["p"] != before(i)["p"]) & ~((after(i)["m"] < 0) & (after(i)["p"] == v["p"]))))
    cut = cut.withColumn("pts", F.transform(new, lambda v: v["p"])).select(*lines.columns)
    renamed = _with_ends(cut.withColumnRenamed("line_id", "id"), found.select(F.col("line_id").alias("id"), "far", place.alias("p")))
    return renamed.withColumnRenamed("id", "line_id")
