"""Points against lines and areas: locating, snapping, nearest segment, clipping and height cells.

Nearness is an equality join on grid cells. Edges are listed in every cell they can serve, so that a point
looks in its own cell only and the large side is neither multiplied nor regrouped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.functions.geometry import point
from chainmark.operators.area_cover import cover, inside_any, ring_edges
from chainmark.operators.scale import BROADCAST_BYTES, HOT_ROWS, lookup_join, salted_join, shuffled
from chainmark.session import checkpointed

CELL_EDGES = 2048
SPLIT = 4


def _foot(x: Column, y: Column, e) -> tuple[Column, Column, Column, Column]:
    """Share, distance and position of the nearest position on an edge."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    square = dx * dx + dy * dy
    share = F.when(square == 0, F.lit(0.0)).otherwise(
        F.least(F.greatest(((x - e["x1"]) * dx + (y - e["y1"]) * dy) / square, F.lit(0.0)), F.lit(1.0)))
    px, py = e["x1"] + share * dx, e["y1"] + share * dy
    return share, F.sqrt((x - px) * (x - px) + (y - py) * (y - py)), px, py


def edge_cells(edges: DataFrame, radius: float, cell: float, occupied: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Cells from which an edge can be within ``radius``; long edges are cut so that diagonals stay thin.

    With ``occupied`` only these cells are listed; those that are too far or hold no point go before any shuffle of edges.
    """
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    steps = F.greatest(F.ceil(F.sqrt(dx * dx + dy * dy) / F.lit(cell)), F.lit(1)).cast("long")
    parts = edges.withColumn("_steps", steps).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_steps") - 1)))

    def span(a: str, b: str) -> Column:
        p = F.col(a) + (F.col(b) - F.col(a)) * F.col("_i") / F.col("_steps")
        q = F.col(a) + (F.col(b) - F.col(a)) * (F.col("_i") + 1) / F.col("_steps")
        reach = F.lit(radius * (1 + 1e-9) + 1e-6)
        return F.sequence(F.floor((F.least(p, q) - reach) / cell), F.floor((F.greatest(p, q) + reach) / cell))

    listed = parts.withColumn("_cx", F.explode(span("x1", "x2"))).withColumn("_cy", F.explode(span("y1", "y2"))).drop("_steps", "_i")
    if occupied is not None:
        listed = lookup_join(listed, occupied, [*by, "_cx", "_cy"], how="left_semi")
    return listed.distinct()


def finite(geometry: Column) -> Column:
    """Whether a position has both coordinates, as numbers."""
    inf = F.lit(float("inf"))
    return F.coalesce((F.abs(geometry["x"]) < inf) & (F.abs(geometry["y"]) < inf), F.lit(False))


def _split_cells(crowd: DataFrame, occupied: DataFrame, keys: Sequence[str], rank: Sequence[str], size: float, radius: float) -> DataFrame:
    """Edges of crowded cells in the sub-cells that hold points, without those that are nearest nowhere in a sub-cell.

    Of a sub-cell with half diagonal h, the nearest edge is at most h farther from a point than from the centre.
    So an edge is left out when its rank holds one nearer to the centre by more than 2 h, when it is out of reach
    of the whole sub-cell, or when an edge of better rank is within reach from everywhere in it.
    """
    half = size * 0.7071067811865476 * (1 + 1e-9) + 1e-9
    parents = [F.floor(F.col(c) / SPLIT).alias(f"{c}_up") for c in ("_cx", "_cy")]
    below = occupied.select(*[k for k in keys if k not in ("_cx", "_cy")], "_cx", "_cy", *parents)
    up = crowd.withColumnsRenamed({"_cx": "_cx_up", "_cy": "_cy_up"})
    pairs = up.join(shuffled(below), [*[k for k in keys if k not in ("_cx", "_cy")], "_cx_up", "_cy_up"]).drop("_cx_up", "_cy_up")
    centre = [(F.col(c) + 0.5) * size for c in ("_cx", "_cy")]
    measured = pairs.withColumn("_d", _foot(*centre, F.col("_e"))[1]).where(F.col("_d") - half <= radius * (1 + 1e-9))
    measured = measured.withColumn("_rank", F.struct(*[F.col("_e")[c].alias(c) for c in rank]) if rank else F.lit(0))
    nearest = measured.groupBy(*keys, "_rank").agg(F.min("_d").alias("_least"))
    kept = measured.join(shuffled(nearest), [*keys, "_rank"]).where(F.col("_d") <= F.col("_least") + 2 * half)
    if rank:
        sure = nearest.where(F.col("_least") + half <= radius).groupBy(*keys).agg(F.min("_rank").alias("_sure"))
        kept = kept.join(shuffled(sure), list(keys), "left").where(F.col("_sure").isNull() | (F.col("_rank") <= F.col("_sure"))).drop("_sure")
    return kept.select(*keys, "_e")


def nearest_edge(
    points: DataFrame, edges: DataFrame, radius: float, rank: Sequence[str] = (), carry: Sequence[str] = (),
    by: Sequence[str] = (), geometry: str = "geometry", out: str = "near", cell_edges: int = CELL_EDGES,
    limit_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS, splits: int = 4,
) -> DataFrame:
    """Nearest edge within ``radius`` as a struct column, null where there is none or the point has no finite place.

    ``edges`` has x1, y1, x2, y2, seq and the ``carry`` columns. Ties go by ``rank`` columns first, then
    distance, then the carried columns. ``by`` columns must be equal on both sides.

    Edges are listed once, in cells that hold points. A cell with more than ``cell_edges`` edges is split, by its
    own count, into sub-cells that drop the edges nearest nowhere in them; splitting ends where it thins no more.
    What stays crowded is asked once for each distinct position.
    """
    cell = 2.0 * radius
    keys = [*by, "_cx", "_cy"]
    names = list(dict.fromkeys([*rank, *carry, "seq", "x1", "y1", "x2", "y2", *(c for c in ("m0", "m1") if c in edges.columns)]))
    x, y = F.col("_px"), F.col("_py")
    there = finite(F.col(geometry))
    placed = points.withColumns({"_px": F.when(there, F.col(geometry)["x"]), "_py": F.when(there, F.col(geometry)["y"])})
    placed = placed.withColumns({"_cx": F.floor(x / cell), "_cy": F.floor(y / cell), "_level": F.lit(0)})
    spots = checkpointed(placed.where(x.isNotNull()).select(*by, "_px", "_py", "_cx", "_cy", "_level").distinct())
    occupied = spots.select(*keys).distinct()
    listed = edge_cells(edges.select(*[c for c in names if c not in by], *by), radius, cell, occupied, by)
    listed = checkpointed(listed.select(*keys, F.struct(*[c for c in names if c not in by]).alias("_e")))

    def answer(e, px: Column, py: Column) -> Column:
        share, dist, fx, fy = _foot(px, py, e)
        fields = [e[c].alias(c) for c in rank] + [dist.alias("dist")]
        fields += [e[c].alias(c) for c in dict.fromkeys([*carry, "seq"]) if c not in rank and c not in by]
        if "m0" in edges.columns:
            fields.append((e["m0"] + share * (e["m1"] - e["m0"])).alias("measure"))
        return F.struct(*fields, fx.alias("x"), fy.alias("y"))

    thin, level, size = [], 0, cell
    per_cell = checkpointed(listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    while True:
        crowded = per_cell.where(F.col("_n") > cell_edges)
        fits = lookup_join(listed, crowded.select(*keys), keys, how="left_anti", limit_bytes=limit_bytes)
        thin.append(fits.withColumn("_level", F.lit(level)))
        if level == splits or crowded.limit(1).count() == 0:
            break
        crowd = lookup_join(listed, crowded.select(*keys), keys, how="left_semi", limit_bytes=limit_bytes)
        # Spots of crowded cells move to their sub-cells.
        marked = lookup_join(spots.where(F.col("_level") == level), crowded.select(*keys, F.lit(True).alias("_crowded")), keys, limit_bytes=limit_bytes)
        level, size = level + 1, size / SPLIT
        finer = {"_cx": F.floor(x / size), "_cy": F.floor(y / size), "_level": F.lit(level)}
        moved = marked.where("_crowded").drop("_crowded").withColumns(finer)
        stay = spots.where(F.col("_level") < level - 1).unionByName(marked.where("_crowded is null").drop("_crowded"))
        spots = checkpointed(stay.unionByName(moved))
        listed = checkpointed(_split_cells(crowd, spots.where(F.col("_level") == level).select(*keys).distinct(), keys, rank, size, radius))
        before, per_cell = per_cell, checkpointed(listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
        if per_cell.agg(F.max("_n")).first()[0] == before.agg(F.max("_n")).first()[0]:
            fits = lookup_join(listed, per_cell.where(F.col("_n") > cell_edges).select(*keys), keys, how="left_anti", limit_bytes=limit_bytes)
            thin.append(fits.withColumn("_level", F.lit(level)))
            break
    still = lookup_join(listed, per_cell.where(F.col("_n") > cell_edges).select(*keys), keys, how="left_semi", limit_bytes=limit_bytes)
    leaf = [*by, "_level", "_cx", "_cy"]
    packed = checkpointed(reduce(DataFrame.unionByName, thin).groupBy(*leaf).agg(F.collect_list("_e").alias("_edges")))
    options = F.filter(F.transform("_edges", lambda e: answer(e, x, y)), lambda a: a["dist"] <= radius)
    easy = lookup_join(spots, packed, leaf, None, "inner", limit_bytes, hot_rows).select(*by, "_px", "_py", F.array_min(options).alias(out))
    pairs = salted_join(spots.where(F.col("_level") == level), still, keys, None, "inner", max(hot_rows // max(cell_edges, 1), 1))
    hard = pairs.withColumn("_a", answer(F.col("_e"), x, y)).where(F.col("_a.dist") <= radius).groupBy(*by, "_px", "_py").agg(F.min("_a").alias(out))
    best = checkpointed(easy.where(F.col(out).isNotNull()).unionByName(hard))
    asked = placed.drop("_cx", "_cy", "_level")
    return lookup_join(asked, best, [*by, "_px", "_py"], limit_bytes=limit_bytes, hot_rows=hot_rows).drop("_px", "_py")


def locate(
    points: DataFrame, edges: DataFrame, geometry: str = "geometry", max_distance: float | None = None,
    first_radius: float = 100.0, by: Sequence[str] = ("line_id",), carry: Sequence[str] = (), out: str = "near",
) -> DataFrame:
    """Measure and foot point of the nearest position on a line (on the row's own line by default).

    With ``max_distance`` one pass; without it the search widens for the points still open until none is.
    A point without finite coordinates, or whose line has no edges, stays without an answer.
    """
    if max_distance is not None:
        return nearest_edge(points, edges, max_distance, by=by, carry=carry, geometry=geometry, out=out)
    corner = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x1", "y1", "x2", "y2")]
    box = edges.agg(*corner).first()
    if box["min_x1"] is None:
        return nearest_edge(points, edges, first_radius, by=by, carry=carry, geometry=geometry, out=out)
    g = F.col(geometry)
    ends = points.where(finite(g)).agg(F.min(g["x"]).alias("x0"), F.max(g["x"]).alias("x1"), F.min(g["y"]).alias("y0"), F.max(g["y"]).alias("y1")).first()
    wide = 0.0
    if ends["x0"] is not None:  # no point is farther from an edge than the box around all of them is wide and high
        wide = sum(max(ends[f"{c}1"], box[f"max_{c}1"], box[f"max_{c}2"]) - min(ends[f"{c}0"], box[f"min_{c}1"], box[f"min_{c}2"]) for c in "xy")
    edges = checkpointed(edges)
    known = edges.select(*by).distinct().withColumn("_known", F.lit(True)) if by else None
    todo, done, radius = points, [], first_radius
    while True:
        found = checkpointed(nearest_edge(todo, edges, radius, by=by, carry=carry, geometry=geometry, out=out))
        if known is not None:
            found = lookup_join(found, known, list(by))
        still = F.col(out).isNull() & finite(g) & (F.lit(True) if known is None else F.col("_known").isNotNull())
        found = checkpointed(found.withColumn("_still", still).drop("_known"))
        open_rows = found.where("_still").drop("_still")
        if radius > wide or open_rows.limit(1).count() == 0:
            done.append(found.drop("_still"))
            break
        done.append(found.where("not _still").drop("_still"))
        todo, radius = open_rows.drop(out), radius * 8
    return reduce(lambda a, b: a.unionByName(b), done)


def snap(points: DataFrame, edges: DataFrame, max_distance: float | None = None, geometry: str = "geometry", **options) -> DataFrame:
    """Points moved onto the nearest line, with ``len_from_line_start`` and the line's id.

    Points farther than ``max_distance`` from every line keep their place and get nulls.
    """
    found = locate(points, edges, geometry, max_distance, by=(), carry=("line_id",), out="_near", **options)
    return found.withColumns({
        "snapped_line_id": F.col("_near.line_id"),
        "len_from_line_start": F.col("_near.measure"),
        geometry: F.when(F.col("_near").isNotNull(), point(F.col("_near.x"), F.col("_near.y"))).otherwise(F.col(geometry)),
    }).drop("_near")


def segment_edges(segments: DataFrame) -> DataFrame:
    """Edges of segment shapes, carrying the segment's id, line and number; a bare position counts as an edge."""
    legs = F.when(F.size("geometry") > 1, F.zip_with(
        F.slice("geometry", F.lit(1), F.size("geometry") - 1), F.slice("geometry", F.lit(2), F.size("geometry") - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))).otherwise(
        F.transform("geometry", lambda a: F.struct(a.alias("a"), a.alias("b"))))
    return segments.select("line_id", "chainage_id", F.col("seq"), F.explode(legs).alias("g")).select(
        "line_id", "chainage_id", "seq", F.col("g.a.x").alias("x1"), F.col("g.a.y").alias("y1"),
        F.col("g.b.x").alias("x2"), F.col("g.b.y").alias("y2"))


def nearest_segment(
    points: DataFrame, segments: DataFrame, line_order: Sequence[str], max_distance: float = 100.0,
    geometry: str = "geometry", global_nearest: bool = False, **options,
) -> DataFrame:
    """Nearest segment within reach; lines are tried in order and the first with a hit wins.

    ``global_nearest`` takes the nearest over all lines instead. Adds line, ``chainage_id`` and distance.
    """
    priority = F.lit(len(line_order))
    for i, name in reversed(list(enumerate(line_order))):
        priority = F.when(F.col("line_id") == name, i).otherwise(priority)
    edges = segment_edges(segments).withColumn("priority", priority).withColumnRenamed("line_id", "segment_line_id")
    edges = edges.where(F.col("segment_line_id").isin(list(line_order)))
    rank = () if global_nearest else ("priority",)
    carry = ("priority", "seq", "segment_line_id", "chainage_id") if global_nearest else ("seq", "segment_line_id", "chainage_id")
    found = nearest_edge(points, edges, max_distance, rank=rank, carry=carry, geometry=geometry, out="_near", **options)
    return found.withColumns({
        "segment_line_id": F.col("_near.segment_line_id"), "chainage_id": F.col("_near.chainage_id"),
        "distance": F.col("_near.dist"),
    }).drop("_near")


def switch_rows(points: DataFrame) -> DataFrame:
    """Switch table in its output form, from the surveyed list; positions from eastings and northings if need be."""
    if "geometry" not in points.columns:
        points = points.withColumn("geometry", point(F.col("Easting"), F.col("Northing")))
    return points.select(F.col("Name").alias("id"), F.col("Offset").alias("offset"), F.col("`Chainage 12d (m)`").alias("chainage"), "geometry")


def switch_ids(segments: DataFrame, switches: DataFrame) -> DataFrame:
    """Ids of the switches at each segment, distinct and sorted; an empty list where there are none."""
    listed = (
        switches.where(F.col("chainage_id").isNotNull()).select("chainage_id", F.col("id").alias("_switch")).distinct()
        .groupBy("chainage_id").agg(F.array_sort(F.collect_list("_switch")).alias("switch_ids"))
    )
    return lookup_join(segments, listed, ["chainage_id"]).withColumn(
        "switch_ids", F.coalesce("switch_ids", F.array().cast("array<string>")))


def clip_points(points: DataFrame, areas: DataFrame, area: str = "area_id", geometry: str = "geometry") -> DataFrame:
    """Points inside any polygon, each once (crossing count to the right, half-open in y).

    A quadtree over the ring edges settles cells inside an area without a test; see ``area_cover``. A point meets
    the areas of its cell by equality and is kept by a semi join, so polygons that overlap do not multiply it.
    Points without finite coordinates are in no area.
    """
    placed = points.where(finite(F.col(geometry)))
    covered = cover(areas, area)
    return points.where(F.lit(False)) if covered is None else inside_any(placed, covered, F.col(f"{geometry}.x"), F.col(f"{geometry}.y"))


def clip_lines(lines: DataFrame, areas: DataFrame, key: str, area: str = "area_id", geometry: str = "pts", cell: float | None = None) -> DataFrame:
    """Lines that meet any polygon: a vertex inside, or an edge crossing a ring edge."""
    vertices = lines.select(key, F.explode(geometry).alias("geometry"))
    inside = clip_points(vertices, areas, area).select(key)
    rings = ring_edges(areas, area).select("x1", "y1", "x2", "y2")
    legs = F.zip_with(F.slice(geometry, F.lit(1), F.size(geometry) - 1), F.slice(geometry, F.lit(2), F.size(geometry) - 1),
                      lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    edges = lines.where(F.size(geometry) > 1).select(key, F.explode(legs).alias("e")).select(key, "e.*")
    if cell is None:
        mean = rings.agg(F.avg(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))).alias("h")).first()["h"]
        cell = max(mean or 1.0, 1e-9)
    left = edge_cells(edges, 0.0, cell)
    right = edge_cells(rings, 0.0, cell).select("_cx", "_cy", *[F.col(c).alias(f"r{c}") for c in ("x1", "y1", "x2", "y2")])

    def side(ax, ay, bx, by, px, py) -> Column:
        c = F.col
        return F.signum((c(bx) - c(ax)) * (c(py) - c(ay)) - (c(by) - c(ay)) * (c(px) - c(ax)))

    cross = (side("x1", "y1", "x2", "y2", "rx1", "ry1") != side("x1", "y1", "x2", "y2", "rx2", "ry2")) & \
        (side("rx1", "ry1", "rx2", "ry2", "x1", "y1") != side("rx1", "ry1", "rx2", "ry2", "x2", "y2"))
    crossing = lookup_join(left, right, ["_cx", "_cy"], cross, "inner").select(key)
    hits = checkpointed(inside.unionByName(crossing).distinct())
    return lookup_join(lines, hits, [key], how="left_semi")


def add_height(rows: DataFrame, cells: DataFrame, resolution: float, lng: str = "mid_coord_lng", lat: str = "mid_coord_lat", out: str = "elevation") -> DataFrame:
    """Height of the grid cell a position lies in; ``cells`` has cell_x, cell_y and height."""
    placed = rows.withColumns({
        "_x": F.floor(F.col(lng) / resolution).cast("long"), "_y": F.floor(F.col(lat) / resolution).cast("long")})
    heights = cells.select(F.col("cell_x").cast("long").alias("_x"), F.col("cell_y").cast("long").alias("_y"), F.col("height").alias(out))
    return lookup_join(placed, heights, ["_x", "_y"]).drop("_x", "_y")
