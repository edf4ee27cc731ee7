"""The quadtree over ring edges against the plain crossing count."""

import functools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from chainmark.operators import area_cover, spatial

AREAS = "area_id int, rings array<array<struct<x:double,y:double>>>"
POINTS = "i int, geometry struct<x:double,y:double>"


def _inside(points, rings):
    x, y = np.array([p for _, p in points]).T
    n = np.zeros(len(x), int)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if y1 != y2:
                n += ((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) / (y2 - y1) * (x2 - x1))
    return n % 2 == 1


def _check(spark, areas, points, cell_edges):
    table = spark.createDataFrame(areas, AREAS)
    covered = area_cover.cover(table, cell_edges=cell_edges)
    rows = spark.createDataFrame(points, POINTS).where("geometry is not null")
    got = area_cover.inside_any(rows, covered, F.col("geometry.x"), F.col("geometry.y"))
    assert got.columns == ["i", "geometry"]
    want = np.flatnonzero(np.any([_inside(points, rings) for _, rings in areas], axis=0)).tolist()
    assert 0 < len(want) < len(points)
    assert sorted(r["i"] for r in got.collect()) == want
    return covered


def _star(rng, cx, cy, r, n, whole):
    turn = [(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    ring = [(float(round(x)), float(round(y))) if whole else (x, y) for x, y in turn]
    return ring + ring[:1]


def test_many_areas_on_whole_numbers(spark):
    """Overlapping areas with holes; vertices, level and upright edges and points share whole coordinates."""
    rng = random.Random(5)
    areas = [(k, [_star(rng, rng.randrange(200), rng.randrange(200), 30, 12, True), _star(rng, rng.randrange(200), rng.randrange(200), 9, 5, True)]) for k in range(25)]
    areas += [(90, [[(10.0, 10.0), (60.0, 10.0), (60.0, 60.0), (10.0, 60.0), (10.0, 10.0)]])]
    points = [(i, (float(i % 61) * 5 - 50, float(i // 61) * 5 - 50)) for i in range(61 * 61)]
    covered = _check(spark, areas, points, 6)
    assert len(covered[1]) > 1 and covered[1][3].count() > 3  # cells were split more than once


def test_one_area_of_many_edges(spark):
    """A ring of 8,000 edges: listed rows are in proportion to edges, and inner cells hold none."""
    rng = random.Random(7)
    areas = [(1, [_star(rng, 5e5, 6e6, 1000.0, 8_000, False)])]
    x, y = np.random.default_rng(3).uniform(-1.1, 1.1, (2, 1500)) * 1000
    points = [(i, (5e5 + float(a), 6e6 + float(b))) for i, (a, b) in enumerate(zip(x, y))]
    _, _, ends = _check(spark, areas, points, 64)
    assert ends.agg(F.sum(F.size("_ring"))).first()[0] < 30 * 8_000


def test_smooth_area_lists_each_edge_about_once(spark):
    n = 8_000
    ring = [(1000 * math.cos(2 * math.pi * k / n), 1000 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    rng = np.random.default_rng(4)
    points = [(i, (float(a), float(b))) for i, (a, b) in enumerate(rng.uniform(-1100, 1100, (2000, 2)))]
    _, splits, ends = _check(spark, [(1, [ring + ring[:1]])], points, 64)
    rows = ends.select(F.size("_ring").alias("n"), "_base").collect()
    assert sum(r["n"] for r in rows) < 1.3 * n and max(r["n"] for r in rows) <= 64
    assert any(r["n"] == 0 and r["_base"] == 1 for r in rows) and len(rows) < n
    assert sum(level.count() for level in splits.values()) < n / 32


def test_edges_that_no_split_parts(spark):
    """The same area many times, and strips side by side: cells stay whole where splits would only list edges again."""
    square = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0), (0.0, 0.0)]
    strips = [[(0.0, 20 + k / 50), (90.0, 20 + k / 50), (90.0, 20 + k / 50 + 0.01), (0.0, 20 + k / 50 + 0.01), (0.0, 20 + k / 50)] for k in range(60)]
    areas = [(k, [square]) for k in range(60)] + [(100 + k, [s]) for k, s in enumerate(strips)]
    points = [(i, (float(i % 40) * 2.5 - 3, float(i // 40) * 0.515 - 0.6)) for i in range(1600)]
    _, _, ends = _check(spark, areas, points, 8)
    assert ends.agg(F.sum(F.size("_ring"))).first()[0] < 60 * 8 * 64


def test_odd_rows(spark):
    nan = float("nan")
    open_ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    areas = spark.createDataFrame([(1, [open_ring]), (2, [[(50.0, 50.0), (60.0, nan), (60.0, 60.0), (50.0, 50.0)]]), (None, [[(x + 90, y) for x, y in open_ring]]),
                                   (3, []), (4, None), (5, [[(7.0, 7.0)]])], AREAS)
    points = spark.createDataFrame([(1, (1.0, 1.0)), (1, (1.0, 1.0)), (2, (nan, 1.0)), (3, None), (4, (1.0, None)), (5, (float("inf"), 1.0)), (6, (58.0, 58.0)), (7, (91.0, 1.0))], POINTS)
    assert [r["i"] for r in spatial.clip_points(points, areas).collect()] == [1, 1]
    assert spatial.clip_points(points, areas.limit(0)).count() == 0
    assert spatial.clip_points(points.limit(0), areas).count() == 0


def test_levels_share_one_broadcast(spark):
    """Lookups of split cells below the first, one for each level, read one table that is sent out once."""
    rng = random.Random(5)
    areas = [(k, [_star(rng, rng.randrange(200), rng.randrange(200), 30, 12, True)]) for k in range(25)]
    covered = area_cover.cover(spark.createDataFrame(areas, AREAS), cell_edges=6)
    points = spark.createDataFrame([(i, (float(i), float(i))) for i in range(-50, 250)], POINTS)
    inside = area_cover.inside_any(points, covered, F.col("geometry.x"), F.col("geometry.y"))
    inside.collect()
    plan = inside._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(covered[1]) > 2
    assert plan.count("ReusedExchange") == len(covered[1]) - 2


def test_levels_too_large_to_broadcast(spark, monkeypatch):
    """Levels beyond the limit are shuffled one by one, with the same points inside."""
    monkeypatch.setattr(area_cover, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(area_cover, "lookup_join", functools.partial(area_cover.lookup_join, limit_bytes=0))
    rng = random.Random(5)
    areas = [(k, [_star(rng, rng.randrange(200), rng.randrange(200), 30, 12, True)]) for k in range(25)]
    points = [(i, (float(i % 30) * 9 - 40, float(i // 30) * 9 - 40)) for i in range(900)]
    assert len(_check(spark, areas, points, 6)[1]) > 2
