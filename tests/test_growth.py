"""Steps whose cost once grew faster than their input: long vertex lists, joins by estimate, areas piled on each other."""

import math
import time

import pytest
from pyspark.sql import functions as F

from chainmark.operators import area_cover, linear, scale


def _line(spark, n, line="A"):
    return linear.edge_table(spark.range(n + 1).select(F.lit(line).alias("line_id"), F.col("id").alias("seq"), F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y")))


def test_long_path_takes_linear_time(spark):
    """One range over 40,000 edges: repeats are looked for once for each vertex."""
    spark.range(1).select(F.transform(F.array(F.lit(1)), lambda v: v)).collect()
    legs = F.transform(F.sequence(F.lit(1), F.lit(40_000)), lambda i: F.struct(
        i.alias("seq"), F.struct(i.cast("double").alias("x"), F.lit(0.0).alias("y")).alias("s"), F.struct((i + 1).cast("double").alias("x"), F.lit(0.0).alias("y")).alias("e")))
    began = time.time()
    assert spark.range(1).select(legs.alias("legs")).select(F.size(linear._vertices(F.col("legs")))).first()[0] == 40_001
    assert time.time() - began < 15


def _brute(edges, spans):
    """Legs of all spans of a key, edge by edge, as a path without repeats."""
    length = max(e["m1"] for e in edges)
    legs = []
    for a, b in {tuple(min(max(v, 0.0), length) for v in sorted(s)) for s in spans}:
        for e in edges:
            if (a <= e["m1"] and b >= e["m0"]) if a == b else (a < e["m1"] and b > e["m0"]):
                at = [min(max((m - e["m0"]) / (e["m1"] - e["m0"]), 0.0), 1.0) for m in (max(a, e["m0"]), min(b, e["m1"]))]
                legs.append((e["seq"], *[(e["x1"] + t * (e["x2"] - e["x1"]), e["y1"] + t * (e["y2"] - e["y1"])) for t in at]))
    legs.sort()
    path = [legs[0][1]] + [e for _, _, e in legs]
    kept = [p for i, p in enumerate(path) if i == 0 or p != path[i - 1]]
    return path if len(path) <= 2 else path[:2] if len(kept) < 2 else kept


@pytest.mark.parametrize("block", [1, 4, 256])
def test_blocks_give_every_edge_once(spark, monkeypatch, block):
    """Long and short ranges, ranges without length, beyond the ends, on vertices, twice, and two under one key."""
    monkeypatch.setattr(linear, "BLOCK_EDGES", block)
    edges = _line(spark, 100).where("seq <> 40").cache()
    rows, d = edges.collect(), math.sqrt(2.0)
    spans = {"all": [(-5.0, 900.0)], "long": [(90.3, 3.2)], "short": [(7.1, 7.4)], "point": [(50.5, 50.5)], "end": [(500.0, 600.0)], "start": [(-2.0, -1.0)],
             "vertex": [(rows[3]["m1"], rows[3]["m1"])], "edges": [(8 * d, 20 * d)], "twice": [(3.0, 60.0), (3.0, 60.0)], "two": [(3.0, 30.0), (20.0, 80.0)]}
    ranges = spark.createDataFrame([("A", k, a, b) for k, v in spans.items() for a, b in v] + [("A", None, 1.0, 9.0), ("B", "none", 1.0, 2.0)], "line_id string, k string, a double, b double")
    got = {r["k"]: [(p["x"], p["y"]) for p in r["pts"]] for r in linear.substring(ranges, edges, key="k").collect()}
    spans[None] = [(1.0, 9.0)]
    assert got == {k: _brute(rows, v) for k, v in spans.items()}


def test_unmeasured_sides_are_not_broadcast(spark):
    """A side that is small by Spark's estimate but was not measured, or was measured as too large, is shuffled."""
    rows = spark.range(1000).select(F.lit("A").alias("k"), F.col("id").alias("n"), F.lit(1.0).alias("v"))
    for df in (scale.running_sum(rows, ["k"], "n", "v", "before", block=10),
               scale.lookup_join(rows, rows.select("n", F.col("v").alias("w")), ["n"], limit_bytes=0)):
        df.count()
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=merge" in plan
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_piled_areas_are_split_along_their_rim(spark):
    """300 diamonds around one centre: a point seldom meets the edges of more than a few."""
    def ring(r):
        return [(-r, 0.0), (0.0, r / 3), (r, 0.0), (0.0, -r / 3), (-r, 0.0)]

    areas = spark.createDataFrame([(k, [ring(500.0 + 3 * k)]) for k in range(300)], "area_id int, rings array<array<struct<x:double,y:double>>>")
    covered = area_cover.cover(areas, cell_edges=64)
    points = spark.range(6000).select("id", (F.col("id") * 37.7 % 3000 - 1500).alias("x"), (F.col("id") * 7.31 % 900 - 450).alias("y"))
    inside = area_cover.inside_any(points, covered, F.col("x"), F.col("y"))
    r = 500.0 + 3 * 299
    assert {p["id"] for p in inside.collect()} == {p["id"] for p in points.collect() if abs(p["x"]) / r + 3 * abs(p["y"]) / r < 1}
    frame, _, ends = covered
    assert ends.where("size(_ring) = 0").count() > 0
    assert ends.agg(F.sum(F.size("_ring"))).first()[0] < area_cover.LISTED * 4 * 300
    share = F.pow(F.lit(4.0), -F.col("_d"))  # of the frame, so that a cell counts as often as points fall into it
    assert ends.where("size(_ring) > 0").agg(F.sum(share)).first()[0] * frame.size ** 2 < 0.25 * 300 * 2 * r * r / 3
