"""Queries for sources, projections, filters and text forms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.constants import ID_REPAIRS, LINES, MAIN_LINE_CODES, REGION_LINES
from chainmark.functions import columns as C
from chainmark.functions import geometry as G
from chainmark.functions import projection
from chainmark.operators import cleaning
from chainmark.operators.scale import lookup_join
from chainmark.plans import standins as S
from chainmark.plans.registry import query
from chainmark.plans.standins import q, q_sql
from chainmark.session import scratch_path
from chainmark.sources import layers, sinks, tables

WITH_CLEAN = f"with {S.CLEAN_SQL} "


@query("f3_mainline_filter", WITH_CLEAN + f"select id, line_id, {q_sql('chainage')} as chainage from clean where line_id <> 'OTH'")
def f3_mainline_filter(spark, sf_dir):
    rows = cleaning.main_lines(cleaning.derive_ids(S.raw_ids(spark, sf_dir)))
    return rows.select("id", "line_id", q(F.col("chainage")).alias("chainage"))


@query("p1_clean_names", """select p_partkey as chainage_id, p_size as chainage_start_km, p_retailprice as price_aud_m from part""")
def p1_clean_names(spark, sf_dir):
    p = S.table(spark, sf_dir, "part")
    return C.clean_columns(p.select(
        F.col("p_partkey").alias("Chainage ID"), F.col("p_size").alias(" Chainage Start (km)"), F.col("p_retailprice").alias("Price [AUD/m]")))


@query("p2_p3_rename_drop", "select p_partkey as section_id, p_name as name from part")
def p2_p3_rename_drop(spark, sf_dir):
    p = S.table(spark, sf_dir, "part")
    wide = p.select(F.col("p_partkey").alias("asset_name"), F.col("p_name").alias("name"), F.col("p_size").alias("2022"), F.col("p_size").alias("2025"))
    return C.drop_excluded(C.rename(wide, {"asset_name": "section_id"}))


@query("p4_common_columns", "select s_suppkey as key, s_name as name, s_acctbal as balance from supplier "
       "union all select c_custkey, c_name, c_acctbal from customer")
def p4_common_columns(spark, sf_dir):
    s, c = S.table(spark, sf_dir, "supplier"), S.table(spark, sf_dir, "customer")
    return C.union_common([
        s.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit(1).alias("only_here")),
        c.select(F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"), F.col("c_custkey").alias("key"), "c_mktsegment")])


@query("p5_u1_union_lines", "select s_suppkey as key, s_acctbal as balance, cast(null as varchar) as segment, 'TLX' as line_id from supplier "
       "union all select c_custkey, null, c_mktsegment, 'MLX' from customer")
def p5_u1_union_lines(spark, sf_dir):
    s, c = S.table(spark, sf_dir, "supplier"), S.table(spark, sf_dir, "customer")
    return C.union_all([
        s.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.lit("TLX").alias("line_id")),
        c.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.lit("MLX").alias("line_id"))])


@query("p6_id_repair", f"with {S.RAW_SQL} select {S.REPAIRED_SQL} as id, count(*) as n from raw group by 1")
def p6_id_repair(spark, sf_dir):
    return S.raw_ids(spark, sf_dir).select(C.repair_id(F.col("id"), ID_REPAIRS).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("p7_id_parts", WITH_CLEAN + "select line_region as region, code, count(*) as n from clean group by 1, 2")
def p7_id_parts(spark, sf_dir):
    ids = S.raw_ids(spark, sf_dir).select(C.repair_id(F.col("id")).alias("id"))
    return ids.select(C.id_part(F.col("id"), 1).alias("region"), C.id_part(F.col("id"), 2).alias("code")).groupBy("region", "code").agg(F.count(F.lit(1)).alias("n"))


@query("p8_line_id", WITH_CLEAN + f"select line_region, code, line_id, count(*) as n, {q_sql('max(chainage)')} as far_km from clean group by 1, 2, 3")
def p8_line_id(spark, sf_dir):
    rows = cleaning.derive_ids(S.raw_ids(spark, sf_dir)).withColumn("code", C.id_part(F.col("id"), 2))
    return rows.groupBy("line_region", "code", "line_id").agg(F.count(F.lit(1)).alias("n"), q(F.max("chainage")).alias("far_km"))


_REGIONS = ", ".join(f"'{r}'" for r in REGION_LINES)
_CODES = ", ".join(f"'{c}'" for c in MAIN_LINE_CODES)


@query("p9_unknown_regions", WITH_CLEAN + f"select line_region, count(*) as rows from clean where line_region not in ({_REGIONS}) group by 1")
def p9_unknown_regions(spark, sf_dir):
    return cleaning.unknown_regions(cleaning.derive_ids(S.raw_ids(spark, sf_dir)))


@query("a10_unknown_codes", WITH_CLEAN + f"select distinct code from clean where code not in ({_CODES})")
def a10_unknown_codes(spark, sf_dir):
    return cleaning.unknown_codes(cleaning.derive_ids(S.raw_ids(spark, sf_dir)))


@query("j9_known_codes", WITH_CLEAN + f"select code, count(*) as n from clean where code in ({_CODES}) group by 1")
def j9_known_codes(spark, sf_dir):
    rows = S.raw_ids(spark, sf_dir).select(C.id_part(C.repair_id(F.col("id")), 2).alias("code"))
    return rows.where(F.col("code").isin(list(MAIN_LINE_CODES))).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("p10_chainage", f"with {S.RAW_SQL} select major, minor, {q_sql('major + minor / cast(1000 as double)')} as chainage, count(*) as n from raw group by 1, 2, 3")
def p10_chainage(spark, sf_dir):
    rows = S.raw_ids(spark, sf_dir).withColumn("chainage", q(C.chainage_km(F.col("major"), F.col("minor"))))
    return rows.groupBy("major", "minor", "chainage").agg(F.count(F.lit(1)).alias("n"))


@query("p11_numbers", "select p_partkey as key, try_cast(case when p_partkey % 7 = 0 then 'n/a' else cast(p_size as varchar) || '.5' end as double) as number from part")
def p11_numbers(spark, sf_dir):
    text = F.when(F.col("p_partkey") % 7 == 0, "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    return S.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), C.as_double(text).alias("number"))


@query("p12_class_key", f"with {S.SECTIONS_SQL} select lower(replace(classification, ' ', '_')) as class_key, count(*) as n from sections group by 1")
def p12_class_key(spark, sf_dir):
    return S.sections(spark, sf_dir).groupBy(C.class_key(F.col("classification")).alias("class_key")).agg(F.count(F.lit(1)).alias("n"))


@query("p13_p14_chainage_keys", """with hm as (select p_partkey, p_partkey - 37 as s, p_partkey - 36 as e from part)
select p_partkey, 'CHAIN-TLX-S-' || lpad(cast(abs(s) as varchar), 5, '0') || '-E-' || lpad(cast(abs(e) as varchar), 5, '0') || '-MAINLINE' as chainage_id,
  'CHAIN-MLX-S-' || lpad(cast(abs(s) as varchar), 5, '0') || '-E-' || lpad(cast(abs(e) as varchar), 5, '0') || '-MAINLINE' as attribute_key from hm""")
def p13_p14_chainage_keys(spark, sf_dir):
    k = F.col("p_partkey")
    rows = S.table(spark, sf_dir, "part").select(k, C.chainage_key("TLX", k - 37, k - 36).alias("chainage_id"))
    return rows.withColumn("attribute_key", C.attribute_key(F.col("chainage_id")))


@query("p15_rounding", "select o_orderkey, floor(o_totalprice / 7 * 100 + cast(0.5 as double)) / cast(100 as double) as rounded from orders")
def p15_rounding(spark, sf_dir):
    return S.table(spark, sf_dir, "orders").select("o_orderkey", C.half_up(F.col("o_totalprice") / 7, 2).alias("rounded"))


@query("p15_half_even", "select o_orderkey, cast(round_even(o_custkey / cast(8 as double), 2) as double) as rounded, cast(round_even(- o_custkey / cast(2 as double), 0) as double) as whole from orders")
def p15_half_even(spark, sf_dir):
    """Ties: eighths at two decimals, halves at none."""
    k = F.col("o_custkey")
    return S.table(spark, sf_dir, "orders").select("o_orderkey", C.half_even(k / F.lit(8.0), 2).alias("rounded"), C.half_even(-k / F.lit(2.0), 0).alias("whole"))


@query("p17_pairs", "select least(l_partkey, l_suppkey) as a, greatest(l_partkey, l_suppkey) as b, count(*) as n from lineitem group by 1, 2")
def p17_pairs(spark, sf_dir):
    p = C.pair(F.col("l_partkey"), F.col("l_suppkey"))
    return S.table(spark, sf_dir, "lineitem").select(p.alias("p")).groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count(F.lit(1)).alias("n"))


@query("p18_defaults", f"with {S.NODES_SQL} select node_id, coalesce(placement, '') as placement, coalesce(leg, '') as leg from nodes")
def p18_defaults(spark, sf_dir):
    n = S.nodes(spark, sf_dir)
    return n.select("node_id", C.or_default(F.col("placement"), "").alias("placement"), C.or_default(F.col("leg"), "").alias("leg"))


@query("p19_already_clean", WITH_CLEAN + "select line_id, count(*) as n from clean where line_id <> 'OTH' group by 1")
def p19_already_clean(spark, sf_dir):
    ready = cleaning.derive_ids(S.raw_ids(spark, sf_dir))
    return cleaning.clean_measurements(ready).groupBy("line_id").agg(F.count(F.lit(1)).alias("n"))


@query("clean_measurements", WITH_CLEAN + f"""select line_id, line_region, count(*) as n, {q_sql('min(chainage)')} as first_km, {q_sql('max(chainage)')} as last_km
  from clean where line_id <> 'OTH' group by 1, 2""")
def clean_measurements(spark, sf_dir):
    raw = S.raw_ids(spark, sf_dir).withColumnsRenamed({"id": "SF", "major": "Major", "minor": "Minor"})
    return cleaning.clean_measurements(raw).groupBy("line_id", "line_region").agg(
        F.count(F.lit(1)).alias("n"), q(F.min("chainage")).alias("first_km"), q(F.max("chainage")).alias("last_km"))


WITH_RAW_SECTIONS = f"with {S.RAW_SECTIONS_SQL} "


@query("f4_f7_section_filters", WITH_RAW_SECTIONS + f"""select section_id, section, start_km, end_km, {S.SECTION_LINE_SQL.format('start_km')} as line_id
  from raw_sections where seq <> 0 and section not in ('nan', 'LINE', 'Section') and start_km <> end_km and start_km > 0""")
def f4_f7_section_filters(spark, sf_dir):
    return cleaning.prepare_sections(S.raw_sections(spark, sf_dir), skip_first_row=True).select("section_id", "section", "start_km", "end_km", "line_id")


@query("f6_zero_length", WITH_RAW_SECTIONS + "select section_id from raw_sections where start_km = end_km")
def f6_zero_length(spark, sf_dir):
    return cleaning.zero_length(S.raw_sections(spark, sf_dir)).select("section_id")


@query("f8_tag_predicates", f"with {S.NODES_SQL} " + """select node_id, list_has_any(tags, ['ug-closure', 'oh-closure']) as closure,
  list_has_all(tags, ['demand', 'ug']) as ug_demand from nodes""")
def f8_tag_predicates(spark, sf_dir):
    t = F.col("tags")
    return S.nodes(spark, sf_dir).select("node_id", C.has_any(t, ["ug-closure", "oh-closure"]).alias("closure"), C.has_all(t, ["demand", "ug"]).alias("ug_demand"))


@query("f9_k7_tag_sets", "select c_custkey, array_to_string(list_sort(list_distinct(['b', 'a' || cast(c_nationkey as varchar), 'a3'])), ',') as tags from customer")
def f9_k7_tag_sets(spark, sf_dir):
    text = F.concat(F.lit("b, a"), F.col("c_nationkey").cast("string"), F.lit(",a3,,b"))
    rows = S.table(spark, sf_dir, "customer")
    return rows.select("c_custkey", C.join_set(C.tags_of(text)).alias("tags"))


@query("u4_tag_union", f"with {S.NODES_SQL} " + """select node_id,
  array_to_string(list_sort(list_distinct(list_concat(tags, ['ug', 'base']))), ',') as both_tags,
  array_to_string(list_sort(list_intersect(tags, ['ug', 'demand', 'oh'])), ',') as shared_tags from nodes""")
def u4_tag_union(spark, sf_dir):
    more, some = F.array(F.lit("ug"), F.lit("base")), F.array(F.lit("ug"), F.lit("demand"), F.lit("oh"))
    return S.nodes(spark, sf_dir).select("node_id", C.join_set(F.array_union("tags", more)).alias("both_tags"), C.join_set(F.array_intersect("tags", some)).alias("shared_tags"))


_POINT_TEXT = """'{"type":"Feature","properties":{"name":"' || c_name || '"},"geometry":{"type":"Point","coordinates":[' || cast(c_custkey as varchar) || '.5,' || cast(c_nationkey as varchar) || '.25]}}'"""


def _features(spark, sf_dir):
    """Feature texts as a layer file would hold them: points of customers, every ninth one a line."""
    c = S.table(spark, sf_dir, "customer")
    xy = F.concat(F.lit("["), F.col("c_custkey").cast("string"), F.lit(".5,"), F.col("c_nationkey").cast("string"), F.lit(".25]"))
    shape = F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit('"LineString","coordinates":['), xy, F.lit(",[1,2,3]]"))).otherwise(
        F.concat(F.lit('"Point","coordinates":'), xy))
    return c.select(F.concat(F.lit('{"type":"Feature","properties":{"name":"'), F.col("c_name"), F.lit('"},"geometry":{"type":'), shape, F.lit("}}")).alias("value"))


@query("s1_features", "select c_name as name, c_custkey + cast(0.5 as double) as x, c_nationkey + cast(0.25 as double) as y from customer where c_custkey % 9 <> 0")
def s1_features(spark, sf_dir):
    from pyspark.sql import types as T
    rows = layers.features_of(_features(spark, sf_dir), "Point", T.StructType([T.StructField("name", T.StringType())]))
    return rows.select("name", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))


@query("s1_p16_line_features", "select c_name as name, c_custkey + cast(0.5 as double) as x, 2 as vertices, cast(2 as double) as last_y from customer where c_custkey % 9 = 0")
def s1_p16_line_features(spark, sf_dir):
    rows = layers.features_of(_features(spark, sf_dir), "LineString")
    g = F.col("geometry")
    return rows.select(F.col("properties")["name"].alias("name"), F.get(g, F.lit(0))["x"].alias("x"), F.size(g).alias("vertices"), F.element_at(g, -1)["y"].alias("last_y"))


def _layer_rows(spark, sf_dir):
    """Customers as a layer of lines in two parts; every ninth one is a point."""
    c = S.table(spark, sf_dir, "customer")
    y = F.col("c_nationkey").cast("string")
    lines = F.concat(F.lit('"MultiLineString","coordinates":[[[0,'), y, F.lit("],[1,"), y, F.lit("]],[[5,"), y, F.lit("],[6,"), y, F.lit("]]]"))
    shape = F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit('"Point","coordinates":[0,'), y, F.lit("]"))).otherwise(lines)
    text = F.concat(F.lit('{"type":"Feature","properties":{"name":"'), F.col("c_name"), F.lit('"},"geometry":{"type":'), shape, F.lit("}}"))
    return c.select("c_custkey", text.alias("value"))


@query("s1_s2_layers_from_files", "select c_name as name, cast(c_nationkey as double) as y, count(*) as parts, 2 * count(*) as n from customer, range(2) where c_custkey % 9 <> 0 group by 1, 2")
def s1_s2_layers_from_files(spark, sf_dir):
    """Layers written one feature per line and one collection per line, with parts of Multi* geometries, read together.

    Every customer is written; the reader leaves out the points.
    """
    c = _layer_rows(spark, sf_dir)
    each, together = scratch_path(spark, "features"), scratch_path(spark, "collections")
    c.select("value").write.text(each)
    block = F.floor(F.col("c_custkey") / 50)
    listed = c.groupBy(block.alias("block")).agg(F.array_join(F.collect_list("value"), ",").alias("all"))
    listed.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.col("all"), F.lit("]}"))).write.text(together)
    rows = layers.read_geojson(spark, [each, together], "LineString", T.StructType([T.StructField("name", T.StringType())]))
    found = rows.groupBy("name", F.get("geometry", F.lit(0))["y"].alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return found.select("name", "y", (F.col("n") / 2).cast("long").alias("parts"), "n")


@query("s1_split_collections", """select c_name || ' }{ "' || chr(92) || c_nationkey || '"},' as name, c_custkey + cast(0.5 as double) as x, cast(c_nationkey as double) as y from customer""")
def s1_split_collections(spark, sf_dir):
    """Collections of a thousand features and a last one without geometry, each a file of many lines, read in pieces."""
    c = S.table(spark, sf_dir, "customer")
    name = F.concat("c_name", F.lit(' }{ "\\'), F.col("c_nationkey").cast("string"), F.lit('"},'))
    place = F.concat(F.lit('"geometry":{"type":"Point","coordinates":['), F.col("c_custkey").cast("string"), F.lit(".5,"), F.col("c_nationkey").cast("string"), F.lit("]}},"))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(name.alias("name"))), F.lit(",\n"), place)
    part = F.floor(F.col("c_custkey") / 1000).alias("part")
    ends = [(0, '{"type":"FeatureCollection","name":"all } {","crs":{"type":"name","properties":{"name":"local"}},"features":['), (2, '{"type":"Feature","properties":{},"geometry":null}]}')]
    frame = c.select(part).distinct().select("part", F.explode(F.array(*[F.struct(F.lit(n).alias("at"), F.lit(t).alias("value")) for n, t in ends])).alias("e")).select("part", "e.*")
    folder = scratch_path(spark, "collections")
    rows = c.select(part, F.lit(1).alias("at"), feature.alias("value")).unionByName(frame)
    rows.repartition("part").sortWithinPartitions("part", "at").select("part", "value").write.partitionBy("part").text(folder)
    found = layers.read_geojson(spark, folder, "Point", T.StructType([T.StructField("name", T.StringType())]), multiline=True)
    return found.select("name", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))


@query("s15_kind_check", "select 'LineString' as kind, count(*) as rows from customer where c_custkey % 9 = 0")
def s15_kind_check(spark, sf_dir):
    return layers.rejected(_features(spark, sf_dir), "points")


@query("s3_snap_grid", f"select c_custkey, {q_sql('c_acctbal / 7', 8)} as x, {q_sql('c_acctbal / 11', 8)} as y from customer")
def s3_snap_grid(spark, sf_dir):
    rows = S.table(spark, sf_dir, "customer")
    pts = F.array(G.point(F.col("c_acctbal") / 7, F.col("c_acctbal") / 11))
    snapped = rows.select("c_custkey", F.get(G.snap_grid(pts), F.lit(0)).alias("p"))
    return snapped.select("c_custkey", q(F.col("p.x"), 8).alias("x"), q(F.col("p.y"), 8).alias("y"))


@query("s8_s10_positions", "select o_orderkey, o_custkey / cast(8 as double) as x, o_totalprice as y from orders")
def s8_s10_positions(spark, sf_dir):
    rows = S.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") / F.lit(8.0)).alias("Longitude"), F.col("o_totalprice").alias("Latitude"))
    return tables.with_geometry(rows).select("o_orderkey", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))


@query("s9_wkt", "select o_orderkey, o_custkey / cast(8 as double) as x, o_orderkey / cast(4 as double) as y, 3 as vertices, - o_custkey / cast(8 as double) as last_x from orders")
def s9_wkt(spark, sf_dir):
    a, b = (F.col("o_custkey") / F.lit(8.0)).cast("string"), (F.col("o_orderkey") / F.lit(4.0)).cast("string")
    text = F.concat(F.lit("LINESTRING Z ("), a, F.lit(" "), b, F.lit(" 7, 0 1 2,  -"), a, F.lit(" 3.5 0)"))
    rows = S.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("wkt"))
    pts = F.col("pts")
    return tables.lines_from_wkt(rows).select(
        "o_orderkey", F.get(pts, F.lit(0))["x"].alias("x"), F.get(pts, F.lit(0))["y"].alias("y"), F.size(pts).alias("vertices"),
        F.when(F.element_at(pts, -1)["x"] == 0, 0.0).otherwise(F.element_at(pts, -1)["x"]).alias("last_x"))


@query("k1_geojson", "select " + _POINT_TEXT + " as value from customer")
def k1_geojson(spark, sf_dir):
    c = S.table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_name").alias("name"), G.point(F.col("c_custkey") + F.lit(0.5), F.col("c_nationkey") + F.lit(0.25)).alias("geometry"))
    return sinks.geojson_rows(rows, projection.LONLAT)


@query("k2_k3_csv_wkt", f"with {S.EDGES_SQL} " + """select line_id || '_' || cast(seq as varchar) as section_id,
  'LINESTRING (' || cast(cast(x1 as bigint) as varchar) || ' ' || cast(cast(y1 as bigint) as varchar) || ', ' || cast(cast(x2 as bigint) as varchar) || ' ' || cast(cast(y2 as bigint) as varchar) || ')' as geometry from sized""")
def k2_k3_csv_wkt(spark, sf_dir):
    from chainmark.operators.linear import edge_table
    e = edge_table(S.lines(spark, sf_dir))
    rows = e.select(F.concat_ws("_", "line_id", F.col("seq").cast("string")).alias("section_id"),
                    F.array(G.point(F.col("x1"), F.col("y1")), G.point(F.col("x2"), F.col("y2"))).alias("geometry"), "m0")
    return sinks.csv_rows(sinks.geometry_only(rows), projection.LONLAT)


@query("k4_s7_stored_measurements", f"with {S.RP_SQL} select line_id, case when major % 7 <> 0 then cast(major as double) end as x, case when major % 7 <> 0 then cast(1.5 as double) end as y, "
       "28350 as srid, count(*) as n, count(*) filter (major % 5 = 0) as placed from rp group by 1, 2, 3")
def k4_s7_stored_measurements(spark, sf_dir):
    """Every line comes back with its working coordinates, though degrees lie beside them, and without where there were none."""
    rp = S.rp_points(spark, sf_dir).withColumns({
        "geometry": F.when(F.col("major") % 7 != 0, G.point(F.col("major"), F.lit(1.5))),
        "longitude": F.when(F.col("major") % 5 == 0, 116.5), "latitude": F.lit(-31.5)})
    path = scratch_path(spark, "rp")
    sinks.write_measurements(rp, path, 28350)
    g = F.col("geometry")
    return tables.read_measurements(spark, path).groupBy("line_id", g["x"].alias("x"), g["y"].alias("y"), "srid").agg(
        F.count(F.lit(1)).alias("n"), F.count("longitude").alias("placed"))


@query("s6_raw_folder", f"select l_linenumber as \"Major\", count(*) as n, {q_sql('sum(l_quantity)')} as total from lineitem group by 1")
def s6_raw_folder(spark, sf_dir):
    from pyspark.sql import types as T
    path = scratch_path(spark, "raw")
    li = S.table(spark, sf_dir, "lineitem")
    li.select(F.concat_ws("_", F.lit("Avon"), "l_orderkey").alias("SF"), F.col("l_linenumber").alias("Major"), F.col("l_quantity").alias("Minor")) \
        .write.option("header", True).csv(path)
    raw = tables.read_raw_measurements(spark, path, T.StructType.fromDDL("SF string, Major int, Minor double"))
    return raw.groupBy("Major").agg(F.count(F.lit(1)).alias("n"), q(F.sum("Minor")).alias("total"))


@query("s5_s4_attribute_bundle", """select p_partkey as key, p_name as name from part union all select s_suppkey, s_name from supplier""")
def s5_s4_attribute_bundle(spark, sf_dir):
    folder = scratch_path(spark, "sheets")
    p, s = S.table(spark, sf_dir, "part"), S.table(spark, sf_dir, "supplier")
    tables.export_tables({"a": p.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name")),
                          "b": s.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))}, folder)
    bundle = tables.read_sheet_bundles(spark, [{f"{folder}/a": "TLX"}, {f"{folder}/b": "TLX"}])["TLX"]
    return bundle.select(F.col("key").cast("long").alias("key"), "name")


def _lonlat(spark, sf_dir):
    """Positions in the zone's area, from ``customer``."""
    k = F.col("c_custkey")
    return S.table(spark, sf_dir, "customer").select(k, (F.lit(114.0) + (k * 37 % 5000) / F.lit(1000.0)).alias("lon"), (F.lit(-18.0) - (k * 91 % 6000) / F.lit(1000.0)).alias("lat"))


_LONLAT_SQL = "ll as (select c_custkey, 114 + (c_custkey * 37 % 5000) / cast(1000 as double) as lon, -18 - (c_custkey * 91 % 6000) / cast(1000 as double) as lat from customer)"


def _forward_sql(srid: int) -> str:
    z = projection.zone_of(srid)
    k = 2 * z.n ** 0.5 / (1 + z.n)
    east = " + ".join(["eta"] + [f"{a!r} * cos({2.0 * j} * xi) * sinh({2.0 * j} * eta)" for j, a in enumerate(z.alpha, 1)])
    north = " + ".join(["xi"] + [f"{a!r} * sin({2.0 * j} * xi) * cosh({2.0 * j} * eta)" for j, a in enumerate(z.alpha, 1)])
    return f"""s as (select c_custkey, lon, lat, cast(sin(radians(lat)) as double) as s, radians(lon - {z.meridian!r}) as dlon from ll),
t as (select *, sinh(atanh(s) - cast({k!r} as double) * atanh(cast({k!r} as double) * s)) as t from s),
u as (select *, atan2(t, cos(dlon)) as xi, atanh(sin(dlon) / sqrt(1 + t * t)) as eta from t),
en as (select c_custkey, lon, lat, {projection.FALSE_EASTING!r} + cast({z.radius!r} as double) * ({east}) as e,
  {z.north!r} + cast({z.radius!r} as double) * ({north}) as n from u)"""


@query("g1_project", f"with {_LONLAT_SQL}, {_forward_sql(28350)} select c_custkey, {q_sql('e', 2)} as e, {q_sql('n', 2)} as n from en")
def g1_project(spark, sf_dir):
    e, n = projection.forward(F.col("lon"), F.col("lat"), 28350)
    return _lonlat(spark, sf_dir).select("c_custkey", q(e, 2).alias("e"), q(n, 2).alias("n"))


@query("g1_there_and_back", f"with {_LONLAT_SQL} select c_custkey, {q_sql('lon', 7)} as lon, {q_sql('lat', 7)} as lat from ll")
def g1_there_and_back(spark, sf_dir):
    e, n = projection.forward(F.col("lon"), F.col("lat"), 28350)
    lon, lat = projection.inverse(F.col("e"), F.col("n"), 28350)
    return _lonlat(spark, sf_dir).select("c_custkey", e.alias("e"), n.alias("n")).select("c_custkey", q(lon, 7).alias("lon"), q(lat, 7).alias("lat"))


@query("g2_zones", f"with {_LONLAT_SQL} select 32700 + cast(floor((lon + 180) / 6) as integer) + 1 as srid, count(*) as n from ll group by 1")
def g2_zones(spark, sf_dir):
    return _lonlat(spark, sf_dir).groupBy(projection.utm_srid(F.col("lon"), F.col("lat")).alias("srid")).agg(F.count(F.lit(1)).alias("n"))


@query("f1_layer_lines", "select line_id, count(*) as n from (select case p_partkey % 5 when 0 then 'MLX' when 1 then 'SML' when 2 then 'EML' end as line_id from part) where line_id is not null group by 1")
def f1_layer_lines(spark, sf_dir):
    named = S._pick(["Mainline", "Solomon Spur", "Eliwana Mainline", "Yard", "Siding"], F.col("p_partkey"))
    return layers.split_layers(S.table(spark, sf_dir, "part").select(named.alias("Layer"))).groupBy("line_id").agg(F.count(F.lit(1)).alias("n"))


@query("s14_observed_counts", WITH_CLEAN + "select line_id, count(*) as n from clean group by 1")
def s14_observed_counts(spark, sf_dir):
    """What the load report counts while the rows pass, taken from the report."""
    lines = [*LINES, "OTH"]
    counts = {name: F.count_if(F.col("line_id") == name) for name in lines}
    rows, seen = cleaning.counted(cleaning.derive_ids(S.raw_ids(spark, sf_dir)), "rp_rows", **counts)
    rows.write.format("noop").mode("overwrite").save()
    found = seen.get
    return spark.createDataFrame([(name, found[name]) for name in lines if found[name]], "line_id string, n long")


@query("j6_section_attributes", f"with {S.SECTIONS_SQL}" + """, keyed as (select 'D_' || cast(p_partkey % 500 as varchar) as section_id, p_partkey as seq, p_name from part)
select l.l_partkey % 700 as key, any_value(k.name) as name, count(*) as n from lineitem l
left join (select section_id, min_by(p_name, seq) as name from keyed group by 1) k on k.section_id = 'D_' || cast(l.l_partkey % 700 as varchar) group by 1""")
def j6_section_attributes(spark, sf_dir):
    from chainmark.operators.stats import first_section_rows
    p = S.table(spark, sf_dir, "part").select(
        F.concat(F.lit("D_"), (F.col("p_partkey") % 500).cast("string")).alias("section_id"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("name"))
    counts = S.table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 700).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("section_id", F.concat(F.lit("D_"), F.col("key").cast("string")))
    return lookup_join(counts, first_section_rows(p).select("section_id", "name"), ["section_id"]).select("key", "name", "n")
