"""Graph building: node and edge counts of small drawings, and components against brute force."""

import random

from pyspark.sql import functions as F

from chainmark.functions import projection as P
from chainmark.operators import topology
from chainmark.sources.sinks import to_working

# Positions (lon, lat) of nine points; A-G, B-H and C-I lie less than 0.07 m apart.
PLACES = {
    "A": (-119.28888597775532787, 35.49722214067361392), "B": (-119.28868441001461065, 35.49722267675803522),
    "C": (-119.2890875454960451, 35.49722240871582812), "D": (-119.28908741147496642, 35.49721617673448293),
    "E": (-119.28888581022899018, 35.49721557363952229), "F": (-119.28868427599351776, 35.4972149035340081),
    "G": (-119.28868440163830655, 35.49722216580259726), "H": (-119.28888598613174565, 35.49722170091689577),
    "I": (-119.28908754130806358, 35.49722198571174658),
}


def drawing(spark, edges, points):
    lines = spark.createDataFrame([(e, "test", [PLACES[e[0]], PLACES[e[1]]]) for e in edges], "id string, tags string, pts array<struct<x:double,y:double>>")
    nodes = spark.createDataFrame([(n, "test,node", PLACES[n]) for n in points], "id string, tags string, geometry struct<x:double,y:double>")
    return to_working(lines, P.WEB_MERCATOR, "pts"), to_working(nodes, P.WEB_MERCATOR)


def square(spark):
    rows = [("AB", "A", "B", "test", [(0.0, 0.0), (0.0, 1.0)]), ("BC", "B", "C", "test", [(0.0, 1.0), (1.0, 1.0)]), ("CD", "C", "D", "test", [(1.0, 1.0), (1.0, 0.0)])]
    return spark.createDataFrame(rows, "id string, start_id string, end_id string, tags string, pts array<struct<x:double,y:double>>")


def test_lines_only(spark):
    nodes, edges = topology.base_graph(square(spark))
    assert nodes.count() == 4 and edges.count() == 3
    assert nodes.where(F.col("tags") == F.array(F.lit("inferred"))).count() == 4
    assert edges.where(F.col("tags") == F.array(F.lit("test"))).count() == 3


def test_linked_by_ids(spark):
    points = spark.createDataFrame([(n, "test,node", p) for n, p in {"A": (0.0, 0.0), "B": (0.0, 1.0), "C": (1.0, 1.0), "D": (1.0, 0.0)}.items()],
                                   "id string, tags string, geometry struct<x:double,y:double>")
    nodes, edges = topology.graph_by_ids(square(spark), points)
    assert nodes.count() == 4 and {(r["a"], r["b"]) for r in edges.collect()} == {("A", "B"), ("B", "C"), ("C", "D")}
    assert {tuple(sorted(r["tags"])) for r in nodes.collect()} == {("node", "test")}


def test_near_points_stay_apart(spark):
    for edges, count in ((["AB", "BC", "DI", "EH", "FG"], 5), (["AB", "BC", "CI", "BH", "AG", "DI", "EH", "FG"], 8)):
        lines, points = drawing(spark, edges, "ABCDEFGHI")
        nodes, found = topology.base_graph(lines, points, snap_radius=0.01, multigraph=False)
        rows = nodes.collect()
        assert len(rows) == 9 and found.count() == count
        assert all(sorted(r["tags"]) == ["node", "test"] for r in rows)


def test_near_ends_are_moved(spark):
    lines, points = drawing(spark, ["AB", "BC", "DI", "EH", "FG"], "ABCDEF")
    nodes, edges = topology.base_graph(lines, points, snap_radius=0.1, multigraph=False)
    places = {r["node_id"]: tuple(r["geometry"]) for r in nodes.collect()}
    rows = edges.collect()
    assert len(places) == 6 and len(rows) == 5
    assert all(places[r["a"]] == tuple(r["pts"][0]) and places[r["b"]] == tuple(r["pts"][-1]) for r in rows)


def roots(n, links):
    parent = list(range(n))
    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in range(n)}


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(70, i) for i in range(71, 110)] + [(rng.randrange(110, 200), rng.randrange(110, 200)) for _ in range(60)]
    found = topology.components(spark.range(200).withColumnRenamed("id", "v"), spark.createDataFrame(links, "u long, v long"))
    assert {r["v"]: r["root"] for r in found.collect()} == roots(200, links)


def test_merging_against_brute_force(spark):
    """Dense and sparse places, among them pairs at just about the radius."""
    rng = random.Random(9)
    spots = {(round(rng.uniform(0, 12), 2), round(rng.uniform(0, 12), 2)) for _ in range(150)}
    spots |= {(50 + round(rng.uniform(0, 0.7), 3), round(rng.uniform(0, 0.7), 3)) for _ in range(150)} | {(51.4, 0.3), (100.0, 0.0), (101.0, 0.0), (103.0, 0.0)}
    spots = sorted(spots)
    links = [(i, j) for i, a in enumerate(spots) for j, b in enumerate(spots[:i]) if (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= 1.0]
    expect = roots(len(spots), links)
    found = topology.merge_positions(spark.createDataFrame(spots, "x double, y double"), 1.0)
    groups = {}
    for r in found.collect():
        groups.setdefault(tuple(r["root"]), set()).add(spots.index((r["x"], r["y"])))
    want = {}
    for i, root in expect.items():
        want.setdefault(root, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
