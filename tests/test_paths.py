"""Vertex lists made where their ranges and edges lie together: the same lists as edge by edge, and none exchanged."""

import math

import pytest
from pyspark.sql import functions as F

from chainmark.functions import geometry as G
from chainmark.operators import linear, scale
from chainmark.plans import line_queries
from chainmark.session import checkpointed
from test_growth import _brute, _line

EDGES = "line_id string, seq long, x1 double, y1 double, x2 double, y2 double, m0 double, m1 double"
RANGES = "line_id string, k string, a double, b double"


def _exchanged_after_lists(df):
    """Exchanges above the step that makes the lists; -1 where lists are made in no single step."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("MapInArrow")[0]
    return -1 if above == plan else sum(above.count(w) for w in ("Aggregate", "Join", "Repartition", "Sort", "Window"))


def _spans(n, length):
    """Ranges short and long, of no length, touching, reversed and beyond the ends."""
    spans = {f"r{i}": (i * 37.3 % length, i * 37.3 % length + i * i * 0.7 % (length / (1 + i % 5))) for i in range(n)}
    return spans | {"all": (-5.0, 9 * length), "back": (90.3, 3.2), "point": (50.5, 50.5), "end": (5 * length, 6 * length), "start": (-2.0, -1.0), "none": (0.0, 0.0)}


@pytest.mark.parametrize("tile_edges,tile_vertices", [(1 << 20, 1 << 24), (1 << 20, 40), (60, 1 << 24), (0, 1)])
def test_lists_by_tile(spark, monkeypatch, tile_edges, tile_vertices):
    """Whole tiles, tiles dealt over tasks, some or all tiles too full: the same lists, also at vertices and gaps."""
    monkeypatch.setattr(linear, "TILE_EDGES", tile_edges)
    monkeypatch.setattr(linear, "TILE_VERTICES", tile_vertices)
    edges = _line(spark, 300).where("seq not in (40, 41, 200)").cache()
    rows = edges.collect()
    spans = _spans(40, rows[0]["m1"] * 300) | {"vertex": (rows[3]["m1"], rows[3]["m1"]), "edges": (rows[8]["m0"], rows[19]["m1"])}
    ranges = spark.createDataFrame([("A", k, a, b) for k, (a, b) in spans.items()] + [("A", None, 1.0, 9.0), ("B", "lost", 1.0, 2.0), (None, "lost", 1.0, 2.0)], RANGES)
    got = linear.substring(ranges, edges, key="k")
    assert {r["k"]: [(p["x"], p["y"]) for p in r["pts"]] for r in got.collect()} == {k: _brute(rows, [v]) for k, v in (spans | {None: (1.0, 9.0)}).items()}


def test_edges_out_of_order_and_repeated_positions(spark):
    """Edges whose measures go back are looked through; a path that stands still keeps two vertices."""
    there = [("A", i, float(i % 3), 0.0, float((i + 1) % 3), 0.0, m, m + 1.0) for i, m in enumerate([0.0, 1.0, 3.0, 2.0, 4.0, 4.5])]
    still = [("B", i, 7.0, 7.0, 7.0, 7.0, float(i), i + 1.0) for i in range(4)]
    edges = spark.createDataFrame(there + still, EDGES)
    spans = {"A": {"a": (0.5, 3.5), "b": (2.0, 2.0), "c": (1.2, 4.7)}, "B": {"d": (0.5, 3.5), "e": (1.0, 1.5)}}
    ranges = spark.createDataFrame([(n, k, a, b) for n, s in spans.items() for k, (a, b) in s.items()], RANGES)
    got = {r["k"]: [(p["x"], p["y"]) for p in r["pts"]] for r in linear.substring(ranges, edges, key="k").collect()}
    rows = edges.collect()
    assert got == {k: _brute([e for e in rows if e["line_id"] == n], [v]) for n, s in spans.items() for k, v in s.items()}
    assert got["d"] == [(7.0, 7.0)] * 2


def test_lists_are_not_exchanged(spark):
    edges = _line(spark, 300).cache()
    ranges = spark.range(200).select(F.lit("A").alias("line_id"), F.col("id").alias("section_id"), F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"))
    assert _exchanged_after_lists(linear.substring(ranges, edges, key="section_id")) == 0


@pytest.mark.parametrize("tile_edges", [1 << 20, 60])
def test_length_comes_with_the_list(spark, monkeypatch, tile_edges):
    monkeypatch.setattr(linear, "TILE_EDGES", tile_edges)
    edges = _line(spark, 300).where("seq <> 40").cache()
    ranges = spark.createDataFrame([("A", k, a, b) for k, (a, b) in _spans(40, 400.0).items()], RANGES)
    rows = linear.substring(ranges, edges, key="k", length=True).select("length", G.line_length(F.col("pts")).alias("again")).collect()
    assert len(rows) == 46 and all(r["length"] == r["again"] for r in rows)


def test_chords_end_where_the_whole_shapes_end(spark):
    """No list behind a chord is exchanged either."""
    edges = _line(spark, 300).where("seq <> 40").cache()
    ranges = spark.createDataFrame([("A", k, a, b) for k, (a, b) in _spans(40, 400.0).items()], "line_id string, section_id string, a double, b double")
    chords = linear.section_shapes(ranges, edges, method="chord")
    assert _exchanged_after_lists(chords) == 0
    rows = edges.collect()
    whole = {k: _brute(rows, [v]) for k, v in _spans(40, 400.0).items()}
    assert {r["section_id"]: [(p["x"], p["y"]) for p in r["pts"]] for r in chords.collect()} == {k: [v[0], v[-1]] for k, v in whole.items()}


def test_pieces_as_rows(spark):
    """Vertex rows of cut lines are the vertices of the lists, also where a path stands still or crosses blocks and gaps."""
    still = spark.createDataFrame([("B", i, 7.0, 7.0, 7.0, 7.0, float(i), i + 1.0) for i in range(40)], EDGES)
    stops = spark.createDataFrame([("C", i, float(i // 3), 0.0, float((i + 1) // 3), 0.0, float(i), i + 1.0) for i in range(40)], EDGES)
    edges = checkpointed(_line(spark, 700).where("seq <> 256").unionByName(still).unionByName(stops))
    cuts = spark.createDataFrame([(n, m) for n in "ABC" for m in (0.0, 0.5, 1.0, 1.0, 2.25, 9.0, 9.5, 30.0)], "line_id string, measure double")
    lists = linear.cut_lines(edges, cuts).collect()
    rows = linear.cut_lines(edges, cuts, rows=True)
    found = sorted(map(tuple, rows.collect()))
    assert found == sorted((r["line_id"], r["piece"], i, p["x"], p["y"]) for r in lists for i, p in enumerate(r["pts"]))
    joined = {}
    for r in sorted(lists, key=lambda r: r["piece"]):
        joined.setdefault(r["line_id"], []).extend(r["pts"][:-1])
    assert sorted(map(tuple, linear.join_pieces(rows).collect())) == sorted((n, i, p["x"], p["y"]) for n, pts in joined.items() for i, p in enumerate(pts))


def test_out_and_back_makes_no_whole_line(spark, sf_dir, monkeypatch):
    """No row of the query, and none it writes in between, holds more vertices than a block."""
    seen = []
    for module in (linear, scale, line_queries):
        monkeypatch.setattr(module, "checkpointed", lambda df: seen.append(checkpointed(df)) or seen[-1])
    monkeypatch.setattr(linear, "BLOCK_EDGES", 4)
    rows = line_queries.g10_g12_cut_at_passes(spark, sf_dir)
    assert rows.groupBy("line_id", "part").count().agg(F.max("count")).first()[0] > 90
    assert "collect_list" not in rows._jdf.queryExecution().optimizedPlan().toString()
    longest = [df.agg(F.max(F.size(c))).first()[0] or 0 for df in seen for c, kind in df.dtypes if kind.startswith("array")]
    assert longest and max(longest) <= 4
