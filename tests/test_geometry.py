"""Projections against surveyed positions, linear referencing laws, nearness against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chainmark.functions import geometry as G
from chainmark.functions import projection as P
from chainmark.operators import linear, spatial

# Surveyed positions, longitude, latitude, easting and northing in EPSG:28350.
SURVEYED = [
    (118.563922, -20.397674, 663195.053, 7743734.668),
    (118.564677, -20.396418, 663275.268, 7743872.994),
    (118.563301, -20.398592, 663129.347, 7743633.693),
    (118.562939, -20.399391, 663090.741, 7743545.606),
]


def test_projection_meets_survey(spark):
    df = spark.createDataFrame(SURVEYED, "lon double, lat double, e double, n double")
    e, n = P.forward(F.col("lon"), F.col("lat"), 28350)
    assert df.select(F.max(F.hypot(e - F.col("e"), n - F.col("n"))).alias("d")).first()["d"] < 0.1


@pytest.mark.parametrize("srid", [28350, 32650, 32733, 3857, 4326])
def test_there_and_back(spark, srid):
    lon0 = 117.0 if srid not in (32733,) else 15.0
    df = spark.range(500).select((F.lit(lon0 - 2.9) + F.col("id") % 59 / 10).alias("lon"), (F.lit(-60.0) + F.col("id") * 0.24).alias("lat"))
    e, n = P.forward(F.col("lon"), F.col("lat"), srid)
    df = df.withColumns({"e": e, "n": n})
    lon, lat = P.inverse(F.col("e"), F.col("n"), srid)
    row = df.select(F.max(F.abs(lon - F.col("lon"))).alias("a"), F.max(F.abs(lat - F.col("lat"))).alias("b")).first()
    assert row["a"] < 1e-7 and row["b"] < 1e-7


def test_working_crs(spark):
    layer = spark.createDataFrame([((118.5, -20.4),)], "geometry struct<x:double,y:double>")
    empty = spark.createDataFrame([], "geometry array<struct<x:double,y:double>>")
    assert P.working_srid("epsg:28350", []) == 28350
    assert P.working_srid("utm", [empty, layer]) == 32750
    assert P.working_srid("utm", [empty]) == 3857
    mixed = spark.createDataFrame([((lon, -20.0),) for lon in (140.0, 118.0, 118.5, 140.5, 100.0)], "geometry struct<x:double,y:double>")
    assert P.working_srid("utm", [mixed]) == P.working_srid("utm", [mixed.orderBy("geometry")]) == 32750
    with pytest.raises(ValueError):
        P.zone_of(9999)


def random_lines(rng, names, steps=12):
    out = []
    for k, name in enumerate(names):
        x, y, pts = 0.0, 100.0 * k, []
        for _ in range(steps):
            pts.append((round(x, 3), round(y, 3)))
            x, y = x + rng.uniform(1, 60), y + rng.uniform(-30, 30)
        out.append((name, pts))
    return out


LINES = "line_id string, pts array<struct<x:double,y:double>>"


def on_line(pts, m):
    for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
        d = math.hypot(x2 - x1, y2 - y1)
        if m <= d:
            return x1 + m / d * (x2 - x1), y1 + m / d * (y2 - y1)
        m -= d
    return pts[-1]


def length(pts):
    return sum(math.hypot(b[0] - a[0], b[1] - a[1]) for a, b in zip(pts, pts[1:]))


def test_linear_laws(spark):
    """Locate after interpolate gives the measure back; parts of a line add up to it; ends are clamped."""
    rng = random.Random(5)
    lines = random_lines(rng, ["A", "B"])
    edges = linear.edge_table(spark.createDataFrame(lines, LINES))
    asked = [(i, name, rng.uniform(-20, length(pts) + 20)) for i in range(60) for name, pts in lines]
    rows = spark.createDataFrame(asked, "i int, line_id string, measure double")
    placed = linear.interpolate(rows, edges)
    shapes = dict(lines)
    for r in placed.collect():
        total = length(shapes[r["line_id"]])
        x, y = on_line(shapes[r["line_id"]], min(max(r["measure"], 0.0), total))
        assert (r["geometry"]["x"], r["geometry"]["y"]) == (pytest.approx(x, abs=1e-6), pytest.approx(y, abs=1e-6))
    for r in spatial.locate(placed, edges, first_radius=5.0).collect():
        assert r["near"]["dist"] == pytest.approx(0, abs=1e-6)
        foot = on_line(shapes[r["line_id"]], r["near"]["measure"])
        assert foot == (pytest.approx(r["geometry"]["x"], abs=1e-6), pytest.approx(r["geometry"]["y"], abs=1e-6))
    cuts = spark.createDataFrame([("A", 30.0), ("A", 31.5), ("A", 0.0), ("A", 1e9), ("B", 100.0)], "line_id string, measure double")
    pieces = linear.cut_lines(edges, cuts).withColumn("d", G.line_length(F.col("pts"))).collect()
    assert sorted((r["line_id"], r["piece"]) for r in pieces) == [("A", 0), ("A", 1), ("A", 2), ("B", 0), ("B", 1)]
    for name, pts in lines:
        assert sum(r["d"] for r in pieces if r["line_id"] == name) == pytest.approx(length(pts), abs=1e-6)
        at = 0.0
        for r in sorted((r for r in pieces if r["line_id"] == name), key=lambda r: r["piece"]):
            assert (r["pts"][0]["x"], r["pts"][0]["y"]) == (pytest.approx(on_line(pts, at)[0], abs=1e-6), pytest.approx(on_line(pts, at)[1], abs=1e-6))
            at += r["d"]


def test_degenerate_substring(spark):
    edges = linear.edge_table(spark.createDataFrame([("A", [(0.0, 0.0), (10.0, 0.0), (20.0, 0.0)])], LINES))
    ranges = spark.createDataFrame([("A", "mid", 5.0, 5.0), ("A", "vertex", 10.0, 10.0), ("A", "past", 50.0, 70.0), ("A", "all", -5.0, 99.0)], "line_id string, range_id string, a double, b double")
    found = {r["range_id"]: [tuple(p) for p in r["pts"]] for r in linear.substring(ranges, edges).collect()}
    assert found == {"mid": [(5.0, 0.0)] * 2, "vertex": [(10.0, 0.0)] * 2, "past": [(20.0, 0.0)] * 2, "all": [(0.0, 0.0), (10.0, 0.0), (20.0, 0.0)]}


def test_segments(spark):
    edges = linear.edge_table(spark.createDataFrame([("TLX", [(0.0, 0.0), (120.0, 0.0), (120.0, 0.0), (250.0, 0.0)]), ("MLX", [(0.0, 9.0), (200.0, 9.0)])], LINES))
    rows = linear.chainage_segments(edges).orderBy("line_id", "seq").collect()
    ids = [(r["chainage_id"], r["is_partial"], [tuple(p) for p in r["geometry"]]) for r in rows]
    assert ids == [
        ("CHAIN-MLX-S-00269-E-00270-MAINLINE", False, [(0.0, 9.0), (100.0, 9.0)]),
        ("CHAIN-MLX-S-00270-E-00271-MAINLINE", False, [(100.0, 9.0), (200.0, 9.0)]),
        ("CHAIN-TLX-S-00266-E-00267-MAINLINE", True, [(0.0, 0.0), (50.0, 0.0)]),
        ("CHAIN-TLX-S-00267-E-00268-MAINLINE", False, [(50.0, 0.0), (120.0, 0.0), (150.0, 0.0)]),
        ("CHAIN-TLX-S-00268-E-00269-MAINLINE", False, [(150.0, 0.0), (250.0, 0.0)]),
    ]
    zero = linear.zero_length_edges(spark.createDataFrame([("TLX", [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)]), ("X", [(0.0, 0.0)])], LINES))
    assert [tuple(r) for r in zero.collect()] == [("TLX", 1)]


def test_keys_below_zero(spark):
    edges = linear.edge_table(spark.createDataFrame([("TLX", [(0.0, 0.0), (30600.0, 0.0)])], LINES))
    rows = linear.chainage_segments(edges).orderBy("seq").collect()
    assert rows[0]["chainage_id"] == "CHAIN-TLX-S-00037-E-00036-MAINLINE" and rows[0]["start_hm"] == -37
    assert rows[36]["chainage_id"] == "CHAIN-TLX-S-00001-E-00000-MAINLINE" and rows[-1]["chainage_end_km"] == 26.9


def foot(p, e):
    dx, dy = e[2] - e[0], e[3] - e[1]
    t = 0 if dx == dy == 0 else min(max(((p[0] - e[0]) * dx + (p[1] - e[1]) * dy) / (dx * dx + dy * dy), 0), 1)
    return math.hypot(p[0] - e[0] - t * dx, p[1] - e[1] - t * dy)


@pytest.mark.parametrize("options", [{}, {"cell_edges": 0, "limit_bytes": 0, "hot_rows": 5}])
def test_nearest_against_brute_force(spark, options):
    rng = random.Random(11)
    edges = [(i, *[rng.uniform(0, 300) for _ in range(4)]) for i in range(40)]
    points = [(i, (rng.uniform(-40, 340), rng.uniform(-40, 340)) if i % 10 else (50.0, 50.0)) for i in range(200)] + [(999, None)]
    e = spark.createDataFrame(edges, "seq int, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame(points, "i int, geometry struct<x:double,y:double>")
    for r in spatial.nearest_edge(p, e, 12.0, **options).collect():
        best = min((foot(r["geometry"], e[1:]) for e in edges), default=None) if r["geometry"] else None
        if best is None or best > 12.0:
            assert r["near"] is None
        else:
            assert r["near"]["dist"] == pytest.approx(best, abs=1e-9)


def test_first_line_wins_and_first_segment_counts(spark):
    """The line searched first wins though another is nearer, and its first segment is a hit like any other."""
    segments = spark.createDataFrame(
        [("MLX", "m0", 0, [(0.0, 10.0), (100.0, 10.0)]), ("TLX", "t0", 0, [(0.0, 90.0), (100.0, 90.0)]), ("EML", "far", 0, [(0.0, 900.0), (1.0, 900.0)])],
        "line_id string, chainage_id string, seq int, geometry array<struct<x:double,y:double>>")
    points = spark.createDataFrame([("s1", (50.0, 0.0)), ("s2", (50.0, 400.0)), ("s3", (500.0, 10.0))], "id string, geometry struct<x:double,y:double>")
    order = ["TLX", "MLX", "SML", "EML"]
    ours = spatial.nearest_segment(points, segments, order)
    assert {r["id"]: r["chainage_id"] for r in ours.collect()} == {"s1": "t0", "s2": None, "s3": None}
    near = spatial.nearest_segment(points, segments, order, global_nearest=True)
    assert {r["id"]: (r["chainage_id"], r["segment_line_id"]) for r in near.collect()}["s1"] == ("m0", "MLX")
    ids = {r["chainage_id"]: r["switch_ids"] for r in spatial.switch_ids(segments, ours).collect()}
    assert ids == {"m0": [], "t0": ["s1"], "far": []}


def test_clip(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    hole = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]
    areas = spark.createDataFrame([(1, [square, hole]), (2, [[(8.0, 8.0), (30.0, 8.0), (30.0, 30.0), (8.0, 8.0)]])], "area_id int, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, (1.0, 1.0)), (2, (5.0, 5.0)), (3, (9.0, 8.5)), (4, (25.0, 10.0)), (5, (-1.0, 5.0)), (6, (50.0, 9.0))], "i int, geometry struct<x:double,y:double>")
    assert sorted(r["i"] for r in spatial.clip_points(points, areas).collect()) == [1, 3, 4]
    lines = spark.createDataFrame([("through", [(-5.0, 5.0), (50.0, 5.0)]), ("inside", [(1.0, 1.0), (2.0, 2.0)]), ("away", [(-5.0, -5.0), (50.0, -5.0)]), ("in_hole", [(4.5, 4.5), (5.5, 5.5)])],
                                  "id string, pts array<struct<x:double,y:double>>")
    assert sorted(r["id"] for r in spatial.clip_lines(lines, areas, "id").collect()) == ["inside", "through"]


def test_texts(spark):
    df = spark.createDataFrame([("POINT (1.5 -2)", "LINESTRING Z (0 1 9, 2.5 3 9)", "POLYGON ((0 0, 1 0, 1 1, 0 0), (2 2, 3 2, 3 3, 2 2))")], "p string, l string, g string")
    df = df.select(G.parse_wkt_point(F.col("p")).alias("p"), G.parse_wkt_line(F.col("l")).alias("l"), G.parse_wkt_polygon(F.col("g")).alias("g"))
    row = df.select("*", G.point_wkt(F.col("p")).alias("pw"), G.line_wkt(F.col("l")).alias("lw")).first()
    assert tuple(row["p"]) == (1.5, -2.0) and len(row["g"]) == 2 and tuple(row["g"][1][2]) == (3.0, 3.0)
    assert (row["pw"], row["lw"]) == ("POINT (1.5 -2)", "LINESTRING (0 1, 2.5 3)")
    for kind, column in (("Point", "p"), ("LineString", "l"), ("Polygon", "g")):
        text = df.select(G.feature_json(kind, F.col(column), F.struct(F.lit("n").alias("name"))).alias("value"), F.col(column).alias("was"))
        assert text.where(G.feature_coordinates(F.get(G.feature_parts(F.col("value")), F.lit(0)), kind) == F.col("was")).count() == 1


def test_attributes_are_checked(spark):
    from pyspark.errors import PySparkException

    from chainmark.operators import sections
    segments = spark.createDataFrame([("MLX", "CHAIN-MLX-S-00269-E-00270-MAINLINE", 26.9, 27.0), ("TLX", "CHAIN-TLX-S-00268-E-00269-MAINLINE", 26.8, 26.9), ("EML", "other", 1.0, 1.1)],
                                     "line_id string, chainage_id string, chainage_start_km double, chainage_end_km double")
    track = spark.createDataFrame([("CHAIN-MLX-S-00269-E-00270-MAINLINE", 26.9, 27.0, "x", "good"), ("CHAIN-MLX-S-00268-E-00269-MAINLINE", 26.8, 27.3, "x", "bad")],
                                  "`Chainage ID` string, `Chainage Start (km)` double, `Chainage End (km)` double, `2023` string, `Rail Type` string")
    joined = sections.with_attributes(segments, track)
    assert "2023" not in joined.columns and {(r["rail_type"], r["attributes_agree"]) for r in sections.checked_attributes(joined).collect()} == {("good", True), ("bad", False), (None, False)}
    assert [r["line_id"] for r in sections.mismatched_attributes(joined).collect()] == ["TLX"]
    assert [r["line_id"] for r in sections.missing_attributes(segments, track).collect()] == ["EML"]
    with pytest.raises(PySparkException):
        sections.checked_attributes(joined, strict=True).collect()


def test_missing_coordinates_end_the_search(spark):
    rows = [(1, None), (2, (None, 1.0)), (3, (float("nan"), 1.0)), (4, (float("inf"), 1.0)), (5, (3.0, 4.0)), (6, (1e6, 0.0))]
    points = spark.createDataFrame(rows, "spot_id int, geometry struct<x:double,y:double>")
    edges = spark.createDataFrame([("A", 0, 0.0, 0.0, 10.0, 0.0, 0.0, 10.0)], "line_id string, seq long, x1 double, y1 double, x2 double, y2 double, m0 double, m1 double")
    found = {r["spot_id"]: r["near"] for r in spatial.locate(points, edges, by=(), carry=("line_id",)).collect()}
    assert {k: v and v["measure"] for k, v in found.items()} == {1: None, 2: None, 3: None, 4: None, 5: 3.0, 6: 10.0}
    assert G.point_wkt(F.col("geometry")) is not None
    text = points.select("spot_id", G.point_wkt(F.col("geometry")).alias("t"))
    assert {r["spot_id"]: r["t"] for r in text.where("spot_id in (2, 3, 5)").collect()} == {2: None, 3: None, 5: "POINT (3 4)"}


@pytest.mark.parametrize("rank", [(), ("priority",)])
def test_crowded_cells_agree_with_pairs(spark, rank):
    """Very many edges in one cell, with and without a rank, against all pairs."""
    rng = random.Random(2)
    edges = [(i % 3, i, x, y, x + rng.uniform(-9, 9), y + rng.uniform(-9, 9)) for i in range(400) for x, y in [(rng.uniform(0, 60), rng.uniform(0, 60))]]
    spots = [(k, (rng.uniform(-20, 80), rng.uniform(-20, 80))) for k in range(60)]

    def apart(p, e):
        dx, dy = e[4] - e[2], e[5] - e[3]
        t = min(max(((p[0] - e[2]) * dx + (p[1] - e[3]) * dy) / (dx * dx + dy * dy), 0), 1)
        return ((p[0] - e[2] - t * dx) ** 2 + (p[1] - e[3] - t * dy) ** 2) ** 0.5
    want = {}
    for k, p in spots:
        reach = [((e[0],) if rank else ()) + (apart(p, e), e[1]) for e in edges if apart(p, e) <= 15]
        want[k] = min(reach)[-1] if reach else None
    df = spark.createDataFrame(edges, "priority int, seq long, x1 double, y1 double, x2 double, y2 double")
    found = spatial.nearest_edge(spark.createDataFrame(spots, "k int, geometry struct<x:double,y:double>"), df, 15.0, rank=rank, cell_edges=8)
    assert {r["k"]: r["near"] and r["near"]["seq"] for r in found.collect()} == want


def test_ranges_beyond_the_ends(spark):
    lines = spark.createDataFrame([("A", [(0.0, 0.0), (0.1, 0.0), (0.3, 0.0), (1.0, 0.0)])], "line_id string, pts array<struct<x:double,y:double>>")
    ranges = spark.createDataFrame([("A", 1, 5.0, 9.0), ("A", 2, -3.0, -1.0), ("A", 3, 0.5, 7.0)], "line_id string, range_id int, a double, b double")
    found = {r["range_id"]: [tuple(p) for p in r["pts"]] for r in linear.substring(ranges, linear.edge_table(lines)).collect()}
    assert found[1] == [(1.0, 0.0)] * 2 and found[2] == [(0.0, 0.0)] * 2 and found[3][-1] == (1.0, 0.0)
