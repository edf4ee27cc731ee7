"""Files in and out, and the whole run on a small network."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark import schemas
from chainmark.functions import columns as C
from chainmark.functions import geometry as G
from chainmark.operators import cleaning
from chainmark.plans import cleaning_queries, condition_run
from chainmark.sources import database, layers, sinks, tables

FEATURES = [
    '{ "type": "Feature", "properties": { "name": "a, b", "n": 1 }, "geometry": { "type": "LineString", "coordinates": [ [ 118.5, -20.4, 3 ], [ 118.6, -20.123456789 ] ] } },',
    '{ "type": "Feature", "properties": { "name": null, "n": 2 }, "geometry": { "type": "Point", "coordinates": [ 1, 2 ] } }',
]


@pytest.mark.parametrize("multiline", [False, True])
def test_geojson_in(spark, tmp_path, multiline):
    path = tmp_path / "layer.geojson"
    path.write_text('{\n"type": "FeatureCollection",\n"features": [\n' + "\n".join(FEATURES) + "\n]\n}\n")
    props = T.StructType.fromDDL("name string, n int")
    lines = layers.read_geojson(spark, str(path), "LineString", props, multiline=multiline).collect()
    assert [(r["name"], r["n"], [tuple(p) for p in r["geometry"]]) for r in lines] == [("a, b", 1, [(118.5, -20.4), (118.6, -20.12345679)])]
    points = layers.read_geojson(spark, [str(path), str(path)], "Point", multiline=multiline).collect()
    assert [(dict(r["properties"])["n"], tuple(r["geometry"])) for r in points] == [("2", (1.0, 2.0))] * 2
    texts = layers.feature_texts(spark, str(path))
    assert [tuple(r) for r in layers.rejected(texts, "path").collect()] == [("Point", 1)]


def test_geojson_out_and_in(spark, tmp_path):
    df = spark.createDataFrame([("x", ["s2", "s1"], [(663195.0, 7743734.0), (663275.0, 7743872.0)])], "id string, switch_ids array<string>, geometry array<struct<x:double,y:double>>")
    sinks.write_geojson(df, str(tmp_path / "out"), 28350)
    text = layers.feature_texts(spark, str(tmp_path / "out"))
    row = json.loads(text.first()["value"])
    assert row["properties"] == {"id": "x", "switch_ids": "s1,s2"} and row["geometry"]["coordinates"][0][0] == pytest.approx(118.5639, abs=1e-4)
    back = sinks.to_working(layers.features_of(text, "LineString", T.StructType.fromDDL("id string")), 28350).first()
    assert tuple(back["geometry"][1]) == (pytest.approx(663275.0, abs=0.01), pytest.approx(7743872.0, abs=0.01))
    sinks.write_csv(df, str(tmp_path / "csv"), 28350)
    table = spark.read.option("header", True).csv(str(tmp_path / "csv")).withColumn("geometry", G.parse_wkt_line(F.col("geometry")))
    again = sinks.to_working(table, 28350).first()["geometry"]
    assert [tuple(p) for p in again] == [(pytest.approx(663195.0, abs=1e-3), pytest.approx(7743734.0, abs=1e-3)), (pytest.approx(663275.0, abs=1e-3), pytest.approx(7743872.0, abs=1e-3))]


def test_attribute_tables(spark, tmp_path):
    (tmp_path / "MLX.csv").write_text("Chainage ID,Chainage Start (km),2024\nk1,26.9,x\n")
    (tmp_path / "CURVE_SECTIONS.csv").write_text("Asset Name,Section,Start Chainage (km),End Chainage (km),Classification,Hand\nskipped,LINE,1,2,T,\nc1,SL,180.5,nan,Tangent,\nc2,MN,5,6,Mild Curve,RH\nc3,,7,8,Tangent,\n")
    found = tables.read_attribute_tables(spark, [str(tmp_path / "MLX.csv"), str(tmp_path / "CURVE_SECTIONS.csv")])
    assert set(found) == {"MLX", "CURVE_SECTIONS"}
    ready = {r["section_id"]: r["line_id"] for r in cleaning.prepare_sections(found["CURVE_SECTIONS"], skip_first_row=True).collect()}
    assert ready == {"c2": "TLX", "c3": "TLX"}
    with pytest.raises(ValueError):
        C.clean_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int"))
    with pytest.raises(ValueError):
        tables.with_geometry(spark.range(1))


def test_raw_folder_checks_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("SF,Major,Minor,Latitude,Longitude,Speed,Post Speed\nAvon_SLB_1,180,500,-20.4,118.5,NaN,3\n")
    (tmp_path / "note.txt").write_text("not a table")
    raw = tables.read_raw_measurements(spark, str(tmp_path), schemas.TG_RAW)
    row = cleaning.clean_measurements(tables.with_geometry(raw), 28350).first()
    assert (row["line_id"], row["line_region"], row["chainage"], row["speed"], row["post_speed"], row["srid"]) == ("SML", "Avon", 180.5, None, 3.0, 28350)
    (tmp_path / "b.csv").write_text("SF,Minor,Major,Latitude,Longitude,Speed,Post Speed\nx,1,2,3,4,5,6\n")
    with pytest.raises(Exception):
        tables.read_raw_measurements(spark, str(tmp_path), schemas.TG_RAW).collect()


def test_database_conditions():
    assert database.layer_predicates({"kind": "rail's", "n": [2, 1]}, "path", "p1") == ["label = 'path'", "project_id = 'p1'", "kind = 'rail''s'", "n IN (1, 2)"]
    with pytest.raises(ValueError):
        database.layer_predicates({"a; drop": 1})


def test_database_kind_is_checked_before_writing(spark):
    df = spark.createDataFrame([("POINT (1 2)",)], "geometry string")
    assert database.check_kind(df, "points").count() == 1
    with pytest.raises(ValueError):
        database.write_layer(df, "jdbc:none", "t", "path", "path")


AREAS = "area_id int, rings array<array<struct<x:double,y:double>>>"


def _square(a, b):
    return [[(a, a), (b, a), (b, b), (a, b), (a, a)]]


def test_clipped_layer_is_stored_once(spark, tmp_path):
    areas = spark.createDataFrame([(1, _square(0.0, 4.0))], AREAS)
    points = spark.createDataFrame([(1, (1.0, 1.0), {"a": "1", "b": None}), (2, (9.0, 1.0), None)], "id int, geometry struct<x:double,y:double>, tags map<string,string>")
    path = str(tmp_path / "clip")
    with pytest.raises(ValueError):
        database.current_layer(spark, path)
    first = database.clipped_layer(spark, points, areas, path, "Point")
    assert [r.id for r in first.collect()] == [1]
    assert database.clipped_layer(spark, points.orderBy(F.desc("id")), areas, path, "Point").inputFiles() == first.inputFiles()
    again = database.clipped_layer(spark, points, areas, path, "Point", refresh=True)
    assert again.inputFiles() != first.inputFiles() and database.current_layer(spark, path).inputFiles() == again.inputFiles()


def test_clipped_layer_follows_boundary_source_and_columns(spark, tmp_path):
    points = spark.createDataFrame([(1, (1.0, 1.0)), (2, (9.0, 1.0))], "id int, geometry struct<x:double,y:double>")
    small, large = (spark.createDataFrame([(1, _square(0.0, b))], AREAS) for b in (4.0, 20.0))
    path = str(tmp_path / "clip")
    old = database.clipped_layer(spark, points, small, path, "Point")
    assert old.count() == 1
    assert database.clipped_layer(spark, points, large, path, "Point").count() == 2
    assert database.current_layer(spark, path).count() == 2 and old.count() == 1
    assert database.clipped_layer(spark, points, small, path, "Point").inputFiles() == old.inputFiles()
    assert database.current_layer(spark, path).count() == 1
    assert database.clipped_layer(spark, points, large, path, "Point", keep=["id"]).columns == ["id"]
    assert database.clipped_layer(spark, points.limit(0), large, path, "Point").count() == 0
    half = [spark.createDataFrame([(1, p)], points.schema) for p in ((None, 1.0), (1.0, None))]
    assert len({database.layer_fingerprint(h, small) for h in half}) == 2
    moved = points.withColumn("id", F.when(F.col("id") == 1, F.lit(None)).otherwise(F.col("id")))
    assert {r.id for r in database.clipped_layer(spark, moved, large, path, "Point").collect()} == {None, 2}


def test_failed_clip_leaves_the_stored_one(spark, tmp_path):
    points = spark.createDataFrame([(1, (1.0, 1.0)), (2, (9.0, 1.0))], "id int, geometry struct<x:double,y:double>")
    small, large = (spark.createDataFrame([(1, _square(0.0, b))], AREAS) for b in (4.0, 20.0))
    path = str(tmp_path / "clip")
    old = database.clipped_layer(spark, points, small, path, "Point")
    with pytest.raises(Exception):
        database.clipped_layer(spark, points, large, path, "Point", keep=["no_such_column"])
    halted = tmp_path / "clip" / "snapshots" / (database.layer_fingerprint(points, large, "Point", "id", []) + "-halted")
    halted.mkdir()  # a write that never came to its end
    assert database.current_layer(spark, path).inputFiles() == old.inputFiles()
    assert database.clipped_layer(spark, points, large, path, "Point").count() == 2


@pytest.mark.parametrize("indent", [None, 1])
def test_one_collection_is_read_by_many_tasks(spark, tmp_path, indent):
    odd = ["}", "{", '"', "\\", "\\\\\"}", "},{", "", "a\nb", '{"type":"Feature"}', "}}}{{{", "[", "\u2028"]
    features = [{"type": "Feature", "properties": {"name": odd[i % len(odd)] + str(i), "deep": {"a": [{"b": {}}, {"c": "}"}]}},
                 "geometry": {"type": "Point", "coordinates": [i + 0.5, -i]} if i % 7 else None} for i in range(700)]
    whole = {"type": "FeatureCollection", "name": "x } {", "crs": {"type": "name", "properties": {"name": "l"}}, "bbox": [0, 1], "features": features, "more": {"type": "Other"}}
    path = tmp_path / "layer.geojson"
    path.write_text(json.dumps(whole, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "none.geojson").write_text('{"type": "FeatureCollection", "features": []}\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        texts = layers.feature_texts_split(spark, [str(path), str(tmp_path / "none.geojson")])
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 4
        assert sorted(json.dumps(json.loads(r.value)) for r in texts.collect()) == sorted(json.dumps(f) for f in features)
        rows = layers.read_geojson(spark, [str(path), str(path)], "Point", T.StructType.fromDDL("name string"), multiline=True)
        assert rows.count() == 2 * sum(f["geometry"] is not None for f in features)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_observed_counts(spark):
    df, watch = cleaning.counted(spark.range(7), "seen", odd=F.count_if(F.col("id") % 2 == 1))
    df.collect()
    assert watch.get == {"rows": 7, "odd": 3}


def test_a_line_of_several_features_is_merged(spark):
    """The same line in three features, one of them turned round; apart from each other they are refused."""
    poi = spark.createDataFrame([("mainline_start", (2000.0, 30.0))], "name string, geometry struct<x:double,y:double>")
    cut = spark.createDataFrame([
        ("Mainline", [(0.0, 0.0), (2000.0, 0.0)]), ("Mainline", [(6000.0, -700.0), (6000.0, 0.0), (2000.0, 0.0)]),
        ("Mainline", [(6000.0, -700.0), (2000.0, -700.0), (1990.0, -600.0)])], "Layer string, geometry array<struct<x:double,y:double>>")
    parts = cut
    made = {r["line_id"]: [tuple(p) for p in r["pts"]] for r in condition_run.four_lines(parts, poi).collect()}
    assert made["TLX"] == [(0.0, 0.0), (2000.0, 0.0)]
    assert made["MLX"] == [(2000.0, 0.0), (6000.0, 0.0), (6000.0, -700.0), (2000.0, -700.0), (1990.0, -600.0)]
    with pytest.raises(ValueError, match="MLX"):
        condition_run.four_lines(parts.where("size(geometry) < 3 or geometry[1].y < 0"), poi)


def test_whole_run(spark, tmp_path):
    """A loop at the end of the main line, sections with points, and all outputs."""
    centre = spark.createDataFrame([
        ("Mainline", [(0.0, 0.0), (2000.0, 0.0), (6000.0, 0.0), (6000.0, -700.0), (2000.0, -700.0), (2000.0, 0.0), (1990.0, 0.0)]),
        ("Solomon Spur", [(6000.0, 500.0), (9000.0, 500.0)]), ("Eliwana Mainline", [(0.0, 5000.0), (1000.0, 5000.0)]), ("Yard", [(0.0, 9.0), (1.0, 9.0)]),
    ], "Layer string, geometry array<struct<x:double,y:double>>")
    poi = spark.createDataFrame([("origin", (0.0, 20.0)), ("mainline_start", (2000.0, 30.0))], "name string, geometry struct<x:double,y:double>")
    lines = condition_run.four_lines(centre, poi)
    made = {r["line_id"]: [tuple(p) for p in r["pts"]] for r in lines.collect()}
    assert made["TLX"] == [(0.0, 0.0), (2000.0, 0.0)]
    # The loop comes back to the cut: two pieces, joined end to end, each without its last vertex.
    assert made["MLX"] == [(2000.0, 0.0), (6000.0, 0.0), (6000.0, -700.0), (2000.0, -700.0), (2000.0, 0.0)]
    with pytest.raises(ValueError, match="MLX"):
        condition_run.four_lines(centre.unionByName(centre.where("Layer = 'Mainline'")), poi)
    ids = [f"CHAIN-{n}-S-{a:05d}-E-{a + 1:05d}-MAINLINE" for n, start, k in (("MLX", 249, 20), ("MLX", 269, 90), ("SML", 1740, 30), ("EML", 2887, 10)) for a in range(start, start + k)]
    attributes = spark.createDataFrame([(i, int(i[12:17]) / 10, int(i[12:17]) / 10 + 0.1, "x") for i in ids], "`Chainage ID` string, `Chainage Start (km)` double, `Chainage End (km)` double, `2024` string")
    switches = spark.createDataFrame([("sw1", 1.0, 0.5, 150.0, 40.0), ("sw2", 2.0, 0.5, 2150.0, -40.0), ("sw3", 3.0, 0.5, 150.0, 900.0)],
                                     "Name string, `Chainage 12d (m)` double, Offset double, Easting double, Northing double")
    curves = spark.createDataFrame([
        ("c0", "LINE", "1", "2", "Tangent", None), ("c1", "MN", "25.0", "26.0", "Tangent", None), ("c2", "MN", "26.5", "27.5", "Mild Curve", "RH"),
        ("c3", "SL", "174.0", "175.5", "Sharp Curve", "LH"), ("c4", "EL", "200", "201", "Tangent", None)],
        "`Asset Name` string, Section string, `Start Chainage (km)` string, `End Chainage (km)` string, Classification string, Hand string").withColumn("seq", F.monotonically_increasing_id())
    rp = spark.createDataFrame([(f"{reg}_{code}_{i}", km, float(m), -20.4, 118.5, *[w] * 6) for reg, code, km, m, w in (
        ("Thomas", "MLW", 25, 100, 20.0), ("Thomas", "MLW", 25, 200, 20.0), ("Thomas", "MLW", 26, 600, 1.0), ("Avon", "SLB", 174, 0, 9.0), ("Avon", "ZZZ", 174, 0, 9.0), ("Avon", "SLB", 190, 0, 9.0))
        for i in range(2)], schemas.RP_RAW)
    tg = spark.createDataFrame([("Thomas_MLW_1", 25, 500.0, -20.4, 118.5, 80.0, 90.0)], schemas.TG_RAW)
    result = condition_run.run(centre, switches, attributes, curves, tables.with_geometry(rp), tables.with_geometry(tg), poi=poi)
    for table in (result.rp_sections, result.tg_sections, result.segments, result.switches):  # written once; outputs read the copy
        text = table._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "Scan ExistingRDD" in text and "Join" not in text and "Aggregate" not in text
    rows = {r["section_id"]: r for r in result.rp_sections.collect()}
    assert {k: (r["num_points"], r["status_string"], r["status_level"], r["max_speed"]) for k, r in rows.items()} == {
        "c1": (4, "GRR-GRR", "R", 80.0), "c2": (2, "GGG-GGG", "G", None), "c3": (2, "GGR-GGR", "R", None)}
    # c2 starts on TLX and ends on MLX: its far end is projected back onto the end of TLX
    assert [tuple(p) for p in rows["c2"]["geometry"]] == [(pytest.approx(1600.0), 0.0), (2000.0, 0.0)]
    assert {r["section_id"]: r["geometry"] is None for r in result.sections.collect()} == {"c1": False, "c2": False, "c3": False, "c4": True}
    found = {r["id"]: r["chainage_id"] for r in result.switches.collect()}
    assert found == {"sw1": "CHAIN-TLX-S-00250-E-00251-MAINLINE", "sw2": "CHAIN-MLX-S-00270-E-00271-MAINLINE", "sw3": None}
    assert sorted(result.switches.columns) == sorted(["id", "offset", "chainage", "geometry", "segment_line_id", "chainage_id", "distance"])
    reports = {k: v.collect() for k, v in result.reports.items()}
    assert len(result.segments.collect()) == result.segments.select("chainage_id").distinct().count() and not reports["reversed_sections"]
    assert {r["section_id"] for r in reports["lost_ends"]} == {"c4"} and {r["code"] for r in reports["unknown_codes"]} == {"ZZZ"}
    assert sum(r["points"] for r in reports["unmatched"]) == 2
    few = attributes.where("`Chainage ID` not like '%00270%'")
    wrong = condition_run.run(centre, switches, few, curves, tables.with_geometry(rp), tables.with_geometry(tg), poi=poi).reports["wrong_attributes"]
    assert {r["chainage_id"] for r in wrong.collect()} >= {"CHAIN-MLX-S-00269-E-00270-MAINLINE", "CHAIN-MLX-S-00270-E-00271-MAINLINE"}
    condition_run.write_cleaned(result, str(tmp_path))
    again = tables.read_measurements(spark, str(tmp_path / "rp_data"))
    assert cleaning.clean_measurements(again).count() == 10 and again.where("line_id = 'SML'").count() == 4
    condition_run.write_outputs(result, str(tmp_path))
    assert layers.feature_texts(spark, str(tmp_path / "mlx_segments.geojson")).count() == result.segments.where("line_id = 'MLX'").count()
    assert spark.read.option("header", True).csv(str(tmp_path / "rp_sections.csv")).count() == 3
    assert layers.feature_texts(spark, str(tmp_path / "tg_sections_geoms.geojson")).count() == 1


def test_collections_on_one_line_and_multi_parts(spark, tmp_path):
    multi = '{"type":"Feature","properties":{"n":3},"geometry":{"type":"MultiLineString","coordinates":[[[0,0],[1,1]],[[2,2],[3,3],[4,4]]]}}'
    area = '{"type":"Feature","properties":{"n":4},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}'
    bare = '{"type":"Feature","properties":{"n":5},"geometry":null}'
    path = tmp_path / "one_line.geojson"
    path.write_text('{"type":"FeatureCollection","features":[' + ",".join([multi, bare, area]) + "]}")
    props = T.StructType.fromDDL("n int")
    lines = layers.read_geojson(spark, str(path), "LineString", props).collect()
    assert [(r["n"], len(r["geometry"])) for r in lines] == [(3, 2), (3, 3)]
    areas = layers.read_geojson(spark, [str(path), str(path)], "Polygon", props)
    assert [r["n"] for r in areas.collect()] == [4] * 4
    assert {(r["kind"], r["rows"]) for r in layers.rejected(layers.feature_texts(spark, str(path)), "path").collect()} == {(None, 1), ("MultiPolygon", 1)}
    assert [r["n"] for r in layers.read_geojson(spark, str(path), "Polygon", props, multiline=True).collect()] == [4, 4]
    text = sinks.csv_rows(areas.limit(1), 28350).first()["geometry"]
    assert text.startswith("POLYGON ((") and text.count(",") == 3


def test_scratch_tables_go(spark):
    from chainmark import session
    df = session.stored(spark.range(3), "t")
    assert df.count() == 3 and session.clear_scratch(spark) >= 1


def test_the_layer_query_writes_every_customer(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(cleaning_queries, "scratch_path", lambda _, name: str(tmp_path / name))
    cleaning_queries.s1_s2_layers_from_files(spark, sf_dir)
    assert spark.read.text(str(tmp_path / "features")).count() == spark.read.parquet(f"{sf_dir}/customer.parquet").count()
