"""Base graph from lines and points: nodes at points and line ends, merged within a snapping radius."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.functions.columns import tags_of
from chainmark.operators.scale import lookup_join
from chainmark.session import checkpointed

FINE = 8


def components(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """Connected components as ``(v, root)``, root being the smallest vertex of its component.

    ``links`` has columns u and v. Rounds of large-star and small-star steps (each a minimum per vertex,
    combined before the shuffle) bring long chains together in few rounds; every round is written to the
    shared folder, and the loop ends when a round changes nothing.
    """
    edges = checkpointed(
        links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_low")).select("u", F.least("u", "_low").alias("_low"))
        large = lookup_join(both.where(F.col("v") > F.col("u")), low, ["u"], how="inner").select(F.col("v").alias("u"), F.col("_low").alias("v"))
        large = checkpointed(large.where(F.col("u") != F.col("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("_low"))
        small = lookup_join(large, low, ["u"], how="inner").where(F.col("v") != F.col("_low")).select(F.col("v").alias("u"), F.col("_low").alias("v"))
        edges = checkpointed(small.unionByName(low.select("u", F.col("_low").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if seen == tuple(now):
            break
        seen = tuple(now)
    roots = edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
    return lookup_join(vertices.select("v"), roots, ["v"]).select("v", F.coalesce("root", "v").alias("root"))


def _cell(x: Column, y: Column, size: float) -> Column:
    return F.struct(F.floor(x / size).alias("cx"), F.floor(y / size).alias("cy"))


def _boxes(spots: DataFrame, size: float, level: int) -> DataFrame:
    """Box of the positions in each sub-cell, with the sub-cell it lies in one level up."""
    c = F.col
    placed = spots.select("cell", "x", "y", _cell(c("x"), c("y"), size / FINE ** (level - 1)).alias("up"), _cell(c("x"), c("y"), size / FINE ** level).alias("sub"))
    return placed.groupBy("cell", "up", "sub").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


def _facing(boxes: DataFrame) -> DataFrame:
    """The same boxes under names for the other side of a pair."""
    names = {"cell": "other", "up": "other_up", "sub": "other_sub", "x0": "ox0", "x1": "ox1", "y0": "oy0", "y1": "oy1"}
    return boxes.select(*[F.col(a).alias(b) for a, b in names.items()])


def _judged(pairs: DataFrame, radius: float) -> DataFrame:
    """Pairs of boxes that can be within the radius; ``sure`` where all their positions are."""
    c, zero, limit = F.col, F.lit(0.0), radius * radius
    gap_x, gap_y = F.greatest(c("ox0") - c("x1"), c("x0") - c("ox1"), zero), F.greatest(c("oy0") - c("y1"), c("y0") - c("oy1"), zero)
    far_x, far_y = F.greatest(c("ox1") - c("x0"), c("x1") - c("ox0")), F.greatest(c("oy1") - c("y0"), c("y1") - c("oy0"))
    near = pairs.where(gap_x * gap_x + gap_y * gap_y <= limit)
    return near.select("cell", "other", "sub", "other_sub", (far_x * far_x + far_y * far_y <= limit).alias("sure"))


def cell_links(spots: DataFrame, radius: float) -> DataFrame:
    """Pairs of grid cells that hold positions within ``radius`` of each other; ``spots`` has x, y, cell.

    A cell's diagonal is below the radius, so its own positions belong together without looking at pairs.
    Neighbouring cells are compared through the boxes of their 64 sub-cells: a pair of boxes lies within the
    radius, or beyond it, or is open. Open pairs, of cells not linked yet, are split again, until each box is
    one position and nothing is open. No step pairs positions, however many a cell holds.
    """
    size = radius / math.sqrt(2.0) * (1 - 1e-9)
    boxes = _boxes(spots, size, 1)
    half = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]
    around = F.array(*[F.struct((F.col("cell.cx") + dx).alias("cx"), (F.col("cell.cy") + dy).alias("cy")) for dx, dy in half])
    judged = checkpointed(_judged(boxes.withColumn("other", F.explode(around)).join(_facing(boxes), "other"), radius))
    linked, level = [judged.where("sure").select("cell", "other").distinct()], 1
    while True:
        still = judged.where("not sure").select("cell", "other", F.col("sub").alias("up"), F.col("other_sub").alias("other_up"))
        still = still.join(linked[-1], ["cell", "other"], "left_anti")
        if still.limit(1).count() == 0:
            break
        level += 1
        boxes = checkpointed(_boxes(spots, size, level))
        split = lookup_join(still, boxes, ["cell", "up"], how="inner")
        split = lookup_join(split, _facing(boxes), ["other", "other_up"], how="inner")
        judged = checkpointed(_judged(split, radius))
        linked.append(judged.where("sure").select("cell", "other").distinct())
    return reduce(lambda a, b: a.unionByName(b), linked).select(F.col("cell").alias("u"), F.col("other").alias("v"))


def merge_positions(spots: DataFrame, radius: float) -> DataFrame:
    """Cluster of each position, linking positions within ``radius`` (chains included).

    ``spots`` has distinct x, y; adds ``root``, equal within a cluster.
    """
    if radius <= 0:
        return spots.withColumn("root", F.struct("x", "y"))
    size = radius / math.sqrt(2.0) * (1 - 1e-9)
    placed = checkpointed(spots.withColumn("cell", _cell(F.col("x"), F.col("y"), size)))
    cells = placed.select(F.col("cell").alias("v")).distinct()
    roots = components(cells, cell_links(placed, radius)).select(F.col("v").alias("cell"), "root")
    return lookup_join(placed, roots, ["cell"]).drop("cell")


def graph_by_ids(lines: DataFrame, points: DataFrame, node: str = "id", edge_start: str = "start_id", edge_end: str = "end_id") -> tuple[DataFrame, DataFrame]:
    """B2: nodes are the points; a line joins the two points its id fields name."""
    nodes = points.select(F.col(node).alias("node_id"), tags_of(F.col("tags")).alias("tags"), "geometry")
    edges = lines.select("id", F.col(edge_start).alias("a"), F.col(edge_end).alias("b"), tags_of(F.col("tags")).alias("tags"), "pts")
    ids = nodes.select(F.col("node_id"))
    edges = lookup_join(edges, ids.withColumnRenamed("node_id", "a"), ["a"], how="inner")
    edges = lookup_join(edges, ids.withColumnRenamed("node_id", "b"), ["b"], how="inner")
    return nodes, edges


def base_graph(lines: DataFrame, points: DataFrame | None = None, snap_radius: float = 0.0, multigraph: bool = True) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges from line ends and points.

    Positions within the radius become one node. It takes id, tags and place of its smallest point id; where
    no point is near, the node is tagged ``inferred`` and named by its smallest position. Line ends are moved
    to their node. Without ``multigraph`` the smallest line id stays of lines between the same two nodes.
    """
    first, last = F.get("pts", F.lit(0)), F.element_at("pts", -1)
    ends = lines.select(F.explode(F.array(first, last)).alias("p")).select("p.x", "p.y", F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("tags"))
    every = ends
    if points is not None:
        every = ends.unionByName(points.select(F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"), "id", "tags"))
    clustered = checkpointed(merge_positions(every.select("x", "y").distinct(), snap_radius))
    named = lookup_join(every, clustered, ["x", "y"], how="inner")
    rank = F.struct(F.col("id").isNull().alias("bare"), "id", "x", "y", "tags")
    best = named.groupBy("root").agg(F.min(rank).alias("best"))
    name = F.coalesce(F.col("best.id"), F.concat(F.lit("@"), F.col("best.x").cast("string"), F.lit(" "), F.col("best.y").cast("string")))
    nodes = checkpointed(best.select(
        "root", name.alias("node_id"),
        F.when(F.col("best.bare"), F.array(F.lit("inferred"))).otherwise(tags_of(F.col("best.tags"))).alias("tags"),
        F.struct(F.col("best.x").alias("x"), F.col("best.y").alias("y")).alias("geometry")))
    where = lookup_join(clustered, nodes.select("root", "node_id", F.col("geometry").alias("place")), ["root"], how="inner").drop("root")

    def end(df: DataFrame, at: Column, out: str) -> DataFrame:
        keyed = df.withColumn("x", at["x"]).withColumn("y", at["y"])
        return lookup_join(keyed, where.withColumnsRenamed({"node_id": out, "place": f"{out}_place"}), ["x", "y"], how="inner").drop("x", "y")

    edges = end(end(lines, first, "a"), last, "b")
    middle = F.slice("pts", F.lit(2), F.greatest(F.size("pts") - 2, F.lit(0)))
    edges = edges.select("id", "a", "b", tags_of(F.col("tags")).alias("tags"),
                         F.concat(F.array("a_place"), middle, F.array("b_place")).alias("pts"))
    if not multigraph:
        edges = (
            edges.withColumn("p", F.struct(F.least("a", "b"), F.greatest("a", "b"))).groupBy("p")
            .agg(F.min_by(F.struct("id", "a", "b", "tags", "pts"), "id").alias("e")).select("e.*")
        )
    return nodes.drop("root"), edges
