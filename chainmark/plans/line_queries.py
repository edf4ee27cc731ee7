"""Queries for linear referencing, segments, sections and nearness."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainmark.constants import LINE_CHAINAGES, LINE_START_KM, LINES
from chainmark.functions import geometry as G
from chainmark.operators import linear, scale, sections as sec, spatial
from chainmark.operators.cleaning import prepare_sections
from chainmark.plans import standins as S
from chainmark.plans.registry import query
from chainmark.plans.standins import q, q_sql
from chainmark.session import checkpointed, scratch_path
from chainmark.sources.database import clipped_layer
from chainmark.sources.layers import poi

WITH_EDGES = f"with {S.EDGES_SQL} "


def edges(spark, sf_dir):
    return linear.edge_table(S.vertices(spark, sf_dir))


def stored_edges(spark, sf_dir):
    """The edge table written once, for operators that read it several times."""
    return checkpointed(edges(spark, sf_dir))


@query("g3_edges", WITH_EDGES + f"select line_id, seq, {q_sql('m0', 4)} as m0, {q_sql('m0 + len', 4)} as m1 from edges")
def g3_edges(spark, sf_dir):
    return edges(spark, sf_dir).select("line_id", "seq", q(F.col("m0"), 4).alias("m0"), q(F.col("m1"), 4).alias("m1"))


@query("g3_zero_length_edges", f"with {S.EDGES_SQL.replace('sized as', 'same as (select line_id, seq from legs where x2 is not null and floor(x1 / 3000) = floor(x2 / 3000)), sized as')} select line_id, seq from same")
def g3_zero_length_edges(spark, sf_dir):
    rough = S.lines(spark, sf_dir).withColumn("pts", F.transform("pts", lambda p: G.point(F.floor(p["x"] / 3000), F.lit(0))))
    return linear.zero_length_edges(rough)


@query("g4_lengths", WITH_EDGES + f"select line_id, cast(1 as bigint) as features, {q_sql('length', 3)} as length from totals")
def g4_lengths(spark, sf_dir):
    return linear.lengths_per_line(S.lines(spark, sf_dir)).select("line_id", "features", q(F.col("length"), 3).alias("length"))


@query("f11_duplicate_lines", f"select {S.LINE_SQL.format('p_partkey % 4')} as line_id, count(*) as geometries from part group by 1")
def f11_duplicate_lines(spark, sf_dir):
    v = S.vertices(spark, sf_dir)
    return linear.duplicate_lines(v.select("line_id", F.array(G.point(F.col("x"), F.col("y"))).alias("pts")))


@query("g5_locate", f"with {S.EDGES_SQL}, {S.SPOTS_SQL}, {S.NEAR_SQL.format(on='e.line_id = s.line_id', where='')} "
       f"select spot_id, {q_sql('near.dist', 4)} as dist, {q_sql('near.measure', 4)} as measure from near")
def g5_locate(spark, sf_dir):
    found = spatial.locate(S.spots(spark, sf_dir), stored_edges(spark, sf_dir), first_radius=60.0)
    return found.select("spot_id", q(F.col("near.dist"), 4).alias("dist"), q(F.col("near.measure"), 4).alias("measure"))


@query("g5_normalised", f"with {S.EDGES_SQL}, {S.SPOTS_SQL}, {S.NEAR_SQL.format(on='e.line_id = s.line_id', where='')} "
       f"select s.spot_id, {q_sql('near.near.measure / t.length', 8)} as share from spots s left join near on near.spot_id = s.spot_id and near.near.dist <= 300 join totals t on t.line_id = s.line_id")
def g5_normalised(spark, sf_dir):
    e = stored_edges(spark, sf_dir)
    found = spatial.locate(S.spots(spark, sf_dir), e, max_distance=300.0).withColumn("measure", F.col("near.measure"))
    return linear.normalised(found, e).select("spot_id", q(F.col("share"), 8).alias("share"))


_SNAP = f"""with {S.EDGES_SQL}, {S.SPOTS_SQL}, {S.NEAR_SQL.format(on='abs(e.y1 - s.y) < 25000', where='')}
select s.spot_id, case when near.dist <= 150 then near.line end as snapped_line_id,
  case when near.dist <= 150 then {q_sql('near.measure', 4)} end as measure,
  {q_sql('case when near.dist <= 150 then near.px else s.x end', 4)} as x, {q_sql('case when near.dist <= 150 then near.py else s.y end', 4)} as y
from spots s left join near on s.spot_id = near.spot_id"""


def _snapped(rows):
    return rows.select("spot_id", "snapped_line_id", q(F.col("len_from_line_start"), 4).alias("measure"),
                       q(F.col("geometry.x"), 4).alias("x"), q(F.col("geometry.y"), 4).alias("y"))


@query("g6_snap", _SNAP)
def g6_snap(spark, sf_dir):
    return _snapped(spatial.snap(S.spots(spark, sf_dir), stored_edges(spark, sf_dir), max_distance=150.0))


@query("g6_snap_crowded", _SNAP)
def g6_snap_crowded(spark, sf_dir):
    """Snapping as where cells hold very many edges: distinct positions first, then salted pairs."""
    e = edges(spark, sf_dir).withColumnRenamed("line_id", "line")
    found = spatial.nearest_edge(S.spots(spark, sf_dir), e, 150.0, carry=("line",), cell_edges=0, limit_bytes=0, hot_rows=50)
    near = F.col("near")
    return _snapped(found.withColumns({
        "snapped_line_id": near["line"], "len_from_line_start": near["measure"],
        "geometry": F.when(near.isNotNull(), G.point(near["x"], near["y"])).otherwise(F.col("geometry"))}))


_AT_SQL = f"at_m as (select {S.LINE_SQL.format('l_partkey % 4')} as line_id, l_partkey * 251 + l_linenumber * 7.5 - 300 as m, count(*) as n from lineitem group by 1, 2)"


@query("g7_interpolate", f"with {S.EDGES_SQL}, {_AT_SQL}, " + f"""clamped as (select a.line_id, a.m, a.n, least(greatest(a.m, 0), t.length) as c from at_m a join totals t on a.line_id = t.line_id),
on_edge as (select c.line_id, c.m, c.n, min_by(struct_pack(x := x1 + (c - m0) / len * (x2 - x1), y := y1 + (c - m0) / len * (y2 - y1)), seq) as p
  from clamped c join edges e on e.line_id = c.line_id and m0 <= c and c <= m0 + len + 1e-9 group by 1, 2, 3)
select line_id, {q_sql('m', 1)} as m, n, {q_sql('p.x', 3)} as x, {q_sql('p.y', 3)} as y from on_edge""")
def g7_interpolate(spark, sf_dir):
    k = F.col("l_partkey")
    at = S.table(spark, sf_dir, "lineitem").select(S.line_name(k % 4).alias("line_id"), (k * 251 + F.col("l_linenumber") * F.lit(7.5) - 300).alias("measure"))
    at = at.groupBy("line_id", "measure").agg(F.count(F.lit(1)).alias("n"))
    return linear.interpolate(at, stored_edges(spark, sf_dir)).select(
        "line_id", q(F.col("measure"), 1).alias("m"), "n", q(F.col("geometry.x"), 3).alias("x"), q(F.col("geometry.y"), 3).alias("y"))


def _pieces_sql(ranges: str, key: str) -> str:
    return f"""clipped as (select r.line_id, r.{key}, least(greatest(least(r.a, r.b), 0), t.length) as a, least(greatest(greatest(r.a, r.b), 0), t.length) as b
  from {ranges} r join totals t on r.line_id = t.line_id),
whole as (select c.line_id, c.{key}, c.a, c.b, e.seq, greatest(c.a, e.m0) as f, least(c.b, e.m0 + e.len) as t, e.* exclude (line_id, seq)
  from clipped c join edges e on e.line_id = c.line_id and c.a < e.m0 + e.len and c.b > e.m0),
beyond as (select c.line_id, c.{key}, c.a, c.b, max(e.seq) as seq from clipped c join edges e on e.line_id = c.line_id and c.a = c.b and e.m0 <= c.a group by all),
bits as (select * from whole where a < b union all select d.line_id, d.{key}, d.a, d.b, d.seq, d.a as f, d.a as t, e.* exclude (line_id, seq)
  from beyond d join edges e on e.line_id = d.line_id and e.seq = d.seq),
shapes as (select line_id, {key}, count(*) + 1 as vertices, sum(t - f) as length,
  min_by(x1 + (f - m0) / len * (x2 - x1), seq) as first_x, max_by(y1 + (t - m0) / len * (y2 - y1), seq) as last_y from bits group by 1, 2)"""


def _shape(df, key):
    p = F.col("pts")
    length = F.col("length") if "length" in df.columns else G.line_length(p)
    return df.select("line_id", key, F.size(p).cast("long").alias("vertices"), q(length, 3).alias("length"),
                     q(F.get(p, F.lit(0))["x"], 3).alias("first_x"), q(F.element_at(p, -1)["y"], 3).alias("last_y"))


_SHAPE_SQL = f"vertices, {q_sql('length', 3)} as length, {q_sql('first_x', 3)} as first_x, {q_sql('last_y', 3)} as last_y from shapes"
_RANGES_SQL = f"ranges as (select line_id, section_id, end_km * 1003 + 0.25 as a, start_km * 1001 + 0.25 as b from sections)"


@query("g8_substring", f"with {S.EDGES_SQL}, {S.SECTIONS_SQL}, {_RANGES_SQL}, {_pieces_sql('ranges', 'section_id')} select line_id, section_id, {_SHAPE_SQL}")
def g8_substring(spark, sf_dir):
    s = S.sections(spark, sf_dir)
    ranges = s.select("line_id", "section_id", (F.col("end_km") * 1003 + 0.25).alias("a"), (F.col("start_km") * 1001 + 0.25).alias("b"))
    return _shape(linear.substring(ranges, stored_edges(spark, sf_dir), key="section_id", length=True), "section_id")


_OFFSET_SQL = "(case line_id when 'TLX' then cast(-3.7 as double) when 'MLX' then 26.9 when 'SML' then 174 else 288.7 end)"


@query("g9_by_chainage", f"with {S.EDGES_SQL}, {S.SECTIONS_SQL}, moved as (select line_id, section_id, 1000 * (start_km + 0.01 + {_OFFSET_SQL} - {_OFFSET_SQL}) as a, 1000 * (end_km + 0.01) as b from sections), "
       f"{_pieces_sql('moved', 'section_id')} select line_id, section_id, {_SHAPE_SQL}")
def g9_by_chainage(spark, sf_dir):
    offset = F.lit(0.0)
    for name, km in LINE_START_KM.items():
        offset = F.when(F.col("line_id") == name, km).otherwise(offset)
    s = S.sections(spark, sf_dir).withColumns({
        "start_km": F.col("start_km") + 0.01 + offset, "end_km": F.col("end_km") + 0.01 + offset})
    return _shape(linear.section_shapes(s, stored_edges(spark, sf_dir), method="chainage"), "section_id")


@query("g9_chord", f"with {S.EDGES_SQL}, {S.SECTIONS_SQL}, {_RANGES_SQL}, {_pieces_sql('ranges', 'section_id')} "
       f"select line_id, section_id, cast(2 as bigint) as vertices, {q_sql('first_x', 3)} as first_x, {q_sql('last_y', 3)} as last_y from shapes")
def g9_chord(spark, sf_dir):
    s = S.sections(spark, sf_dir)
    ranges = s.select("line_id", "section_id", (F.col("end_km") * 1003 + 0.25).alias("a"), (F.col("start_km") * 1001 + 0.25).alias("b"))
    return _shape(linear.section_shapes(ranges, stored_edges(spark, sf_dir), method="chord"), "section_id").drop("length")


@query("g10_cut_lines", f"""with {S.EDGES_SQL}, cuts as (select distinct {S.LINE_SQL.format('s_suppkey % 4')} as line_id, s_suppkey * 1711 % 400000 + 0.5 as m from supplier),
marks as (select line_id, cast(0 as double) as a from totals union all select c.line_id, m from cuts c join totals t on c.line_id = t.line_id where m < length),
ranges as (select line_id, row_number() over (partition by line_id order by a) - 1 as piece, a, coalesce(lead(a) over (partition by line_id order by a), 1e12) as b from marks),
{_pieces_sql('ranges', 'piece')} select line_id, piece, {_SHAPE_SQL}""")
def g10_cut_lines(spark, sf_dir):
    k = F.col("s_suppkey")
    cuts = S.table(spark, sf_dir, "supplier").select(S.line_name(k % 4).alias("line_id"), (k * 1711 % 400000 + 0.5).alias("measure"))
    return _shape(linear.cut_lines(stored_edges(spark, sf_dir), cuts), "piece")


def all_segments(spark, sf_dir):
    """100 m segments of the four lines; the first line is counted back from its end."""
    return linear.chainage_segments(stored_edges(spark, sf_dir), LINE_CHAINAGES)


SEGMENTS_SQL = f"""counts as (select line_id, length, cast(ceil(length / 100 - 1e-9) as bigint) as pieces from totals),
segments as (select line_id, length, seq, pieces,
    case when line_id = 'TLX' then 269 - pieces when line_id = 'MLX' then 269 when line_id = 'SML' then 1740 else 2887 end + seq as start_hm,
    case when line_id = 'TLX' then pieces * 100 - length else 0 end as shift
  from (select *, unnest(generate_series(0, pieces - 1)) as seq from counts)),
spans as (select *, 'CHAIN-' || line_id || '-S-' || lpad(cast(abs(start_hm) as varchar), 5, '0') || '-E-' || lpad(cast(abs(start_hm + 1) as varchar), 5, '0') || '-MAINLINE' as chainage_id,
  greatest(seq * 100 - shift, 0) as a, case when seq = pieces - 1 then length else (seq + 1) * 100 - shift end as b from segments)"""


@query("g11_segments", f"with {S.EDGES_SQL}, {SEGMENTS_SQL} select line_id, seq, start_hm, start_hm + 1 as end_hm, chainage_id, {q_sql('a', 3)} as a, {q_sql('b', 3)} as b, {q_sql('b - a', 3)} as length, b - a < 100 - 1e-6 as is_partial from spans")
def g11_segments(spark, sf_dir):
    return all_segments(spark, sf_dir).select("line_id", "seq", "start_hm", "end_hm", "chainage_id", q(F.col("m_start"), 3).alias("a"), q(F.col("m_end"), 3).alias("b"),
                                              q(G.line_length(F.col("geometry")), 3).alias("length"), "is_partial")


_TRACK_SQL = """keys as (select replace(chainage_id, 'TLX', 'MLX') as key, start_hm, line_id from spans),
track as (select key, min(start_hm) / cast(10 as double) + case when min(start_hm) % 17 = 0 then 0.1 else 0 end as s, min(start_hm) / cast(10 as double) + 0.1 as e from keys where abs(start_hm) % 13 <> 0 group by key)"""


def _track(segments):
    """An attribute table for most segments, with wrong kilometres in some rows."""
    from chainmark.functions.columns import attribute_key
    hm = F.min("start_hm")
    return segments.where(F.abs("start_hm") % 13 != 0).groupBy(attribute_key(F.col("chainage_id")).alias("Chainage ID")).agg(
        (hm / F.lit(10.0) + F.when(hm % 17 == 0, 0.1).otherwise(0.0)).alias("Chainage Start (km)"),
        (hm / F.lit(10.0) + 0.1).alias("Chainage End (km)"), F.lit("x").alias("2024"))


@query("j1_attributes", f"with {S.EDGES_SQL}, {SEGMENTS_SQL}, {_TRACK_SQL} select p.line_id, p.chainage_id, {q_sql('t.s', 2)} as table_start_km, t.key is not null as has_attributes from spans p left join track t on t.key = replace(p.chainage_id, 'TLX', 'MLX')")
def j1_attributes(spark, sf_dir):
    segments = all_segments(spark, sf_dir).drop("geometry")
    return sec.with_attributes(segments, _track(segments)).select("line_id", "chainage_id", q(F.col("table_start_km"), 2).alias("table_start_km"), "has_attributes")


@query("f10_mismatched", f"with {S.EDGES_SQL}, {SEGMENTS_SQL}, {_TRACK_SQL} select p.line_id, p.chainage_id from spans p join track t on t.key = replace(p.chainage_id, 'TLX', 'MLX') "
       "where not (floor(t.s * 10 + 0.5) = p.start_hm and floor(t.e * 10 + 0.5) = p.start_hm + 1)")
def f10_mismatched(spark, sf_dir):
    segments = all_segments(spark, sf_dir).drop("geometry")
    return sec.mismatched_attributes(sec.with_attributes(segments, _track(segments))).select("line_id", "chainage_id")


@query("g12_join_loop", WITH_EDGES + ", lists as (select line_id, count(*) as n from vertices group by 1) select line_id, 2 * n - 2 as vertices from lists".replace(", lists", ", lists", 1))
def g12_join_loop(spark, sf_dir):
    p = F.col("pts")
    return S.lines(spark, sf_dir).select("line_id", F.size(G.join_loop(p, F.reverse(p))).cast("long").alias("vertices"))


@query("g10_g12_cut_at_passes", f"""with {S.EDGES_SQL}, placed as (select line_id, x, y, row_number() over (partition by line_id order by seq) - 1 as i, count(*) over (partition by line_id) - 1 as n from vertices),
rest as (select line_id, 'rest' as part, i - 5 as pos, x, y from placed where i >= 5 union all select line_id, 'rest', 2 * n - 5 - i, x, y from placed where i between 1 and n - 1),
head as (select line_id, 'head' as part, i as pos, x, y from placed where i <= 5)
select line_id, part, cast(pos as integer) as pos, {q_sql('x', 3)} as x, {q_sql('y', 3)} as y from (select * from rest union all select * from head)""")
def g10_g12_cut_at_passes(spark, sf_dir):
    """Lines out and back, cut each time they pass their sixth vertex; the pieces after the first are joined. All vertices."""
    there = S.line_vertices(spark, sf_dir)
    back = there.withColumn("seq", 2 * F.col("n") - 1 - F.col("seq"))
    e = checkpointed(linear.edge_table(there.unionByName(back).drop("n")))
    pieces = linear.cut_lines(e, linear.passes(e, there.where("seq = 5").select("line_id", "x", "y")), rows=True)
    head, rest = pieces.where("piece = 0"), linear.join_pieces(pieces.where("piece > 0"))
    both = [df.select("line_id", F.lit(part).alias("part"), F.col("pos").cast("int").alias("pos"), "x", "y") for part, df in (("head", head), ("rest", rest))]
    return both[0].unionByName(both[1]).select("line_id", "part", "pos", q(F.col("x"), 3).alias("x"), q(F.col("y"), 3).alias("y"))


@query("g13_centroids", WITH_EDGES + f"select line_id, {q_sql('sum(len * (x1 + x2) / 2) / sum(len)', 3)} as x, {q_sql('sum(len * (y1 + y2) / 2) / sum(len)', 3)} as y from sized group by 1")
def g13_centroids(spark, sf_dir):
    c = S.lines(spark, sf_dir).select("line_id", G.line_centroid(F.col("pts")).alias("c"))
    return c.select("line_id", q(F.col("c.x"), 3).alias("x"), q(F.col("c.y"), 3).alias("y"))


_AREAS_SQL = """areas as (select s_suppkey as area_id, s_suppkey * 4990 % 499000 as cx, (s_suppkey % 4) * 20000 + cast(250 as double) as cy, 500 + abs(s_acctbal) % 900 as r from supplier),
rings as (select area_id, cx - r as x1, cy as y1, cx as x2, cy + r / 3 as y2 from areas union all select area_id, cx, cy + r / 3, cx + r, cy from areas
  union all select area_id, cx + r, cy, cx, cy - r / 3 from areas union all select area_id, cx, cy - r / 3, cx - r, cy from areas)"""


def areas(spark, sf_dir):
    """Diamond-shaped areas along the lines, from ``supplier``."""
    k, r = F.col("s_suppkey"), (500 + F.abs("s_acctbal") % 900)
    cx, cy = (k * 4990 % 499000).cast("double"), (k % 4) * F.lit(20000.0) + 250.0
    ring = F.array(G.point(cx - r, cy), G.point(cx, cy + r / 3), G.point(cx + r, cy), G.point(cx, cy - r / 3), G.point(cx - r, cy))
    return S.table(spark, sf_dir, "supplier").select(k.alias("area_id"), F.array(ring).alias("rings"))


def _number_sql(x: str) -> str:
    return f"regexp_replace(printf('%.6f', cast({x} as double)), '\\.?0+$', '')"


_CORNERS = [("cx - r", "cy"), ("cx", "cy + r / 3"), ("cx + r", "cy"), ("cx", "cy - r / 3"), ("cx - r", "cy")]


@query("k2_polygon_text", f"with {_AREAS_SQL} select area_id, 'POLYGON ((' || " + " || ', ' || ".join(f"{_number_sql(x)} || ' ' || {_number_sql(y)}" for x, y in _CORNERS) + " || '))' as wkt from areas")
def k2_polygon_text(spark, sf_dir):
    """Polygons as the text that CSV files and database tables hold."""
    return areas(spark, sf_dir).select("area_id", G.polygon_wkt(F.col("rings")).alias("wkt"))


@query("g14_clip_points", f"with {S.SPOTS_SQL}, {_AREAS_SQL}, crossed as (select s.spot_id, e.area_id, count(*) as n from spots s join rings e "
       "on (e.y1 > s.y) <> (e.y2 > s.y) and s.x < e.x1 + (s.y - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) group by 1, 2) select distinct spot_id from crossed where n % 2 = 1")
def g14_clip_points(spark, sf_dir):
    return spatial.clip_points(S.spots(spark, sf_dir), areas(spark, sf_dir)).select("spot_id")


@query("s12_clipped_layer", f"with {S.SPOTS_SQL}, {_AREAS_SQL}, crossed as (select s.spot_id, s.line_id, e.area_id, count(*) as n from spots s join rings e "
       "on (e.y1 > s.y) <> (e.y2 > s.y) and s.x < e.x1 + (s.y - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) group by 1, 2, 3) "
       "select line_id, count(distinct spot_id) as n from crossed where n % 2 = 1 group by 1")
def s12_clipped_layer(spark, sf_dir):
    """A shared layer clipped to the areas, stored, and read back."""
    path = scratch_path(spark, "clipped")
    stored = clipped_layer(spark, S.spots(spark, sf_dir), areas(spark, sf_dir), path, "Point", key="spot_id")
    return stored.groupBy("line_id").agg(F.count(F.lit(1)).alias("n"))


@query("g14_clip_lines", f"""with {S.EDGES_SQL}, {_AREAS_SQL}, ends as (select line_id, seq, x1 as x, y1 as y from sized union all select line_id, seq, x2, y2 from sized),
inside as (select line_id, seq from (select v.line_id, v.seq, v.x, e.area_id, count(*) as n from ends v join rings e
    on (e.y1 > v.y) <> (e.y2 > v.y) and v.x < e.x1 + (v.y - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) group by 1, 2, 3, 4) where n % 2 = 1),
crossing as (select s.line_id, s.seq from sized s join rings r on
    sign((s.x2 - s.x1) * (r.y1 - s.y1) - (s.y2 - s.y1) * (r.x1 - s.x1)) <> sign((s.x2 - s.x1) * (r.y2 - s.y1) - (s.y2 - s.y1) * (r.x2 - s.x1))
    and sign((r.x2 - r.x1) * (s.y1 - r.y1) - (r.y2 - r.y1) * (s.x1 - r.x1)) <> sign((r.x2 - r.x1) * (s.y2 - r.y1) - (r.y2 - r.y1) * (s.x2 - r.x1)))
select line_id || '_' || cast(seq as varchar) as id from (select * from inside union select * from crossing)""")
def g14_clip_lines(spark, sf_dir):
    e = edges(spark, sf_dir).select(F.concat_ws("_", "line_id", F.col("seq").cast("string")).alias("id"),
                                    F.array(G.point(F.col("x1"), F.col("y1")), G.point(F.col("x2"), F.col("y2"))).alias("pts"))
    return spatial.clip_lines(e, areas(spark, sf_dir), "id").select("id")


@query("g15_distances", WITH_EDGES + f"select line_id, seq, {q_sql('len')} as d from sized")
def g15_distances(spark, sf_dir):
    return edges(spark, sf_dir).select("line_id", "seq", q(G.distance(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))).alias("d"))


@query("g16_elevation", "select c_custkey, p.p_size as elevation from customer left join (select p_partkey, p_size from part where p_partkey % 3 <> 0) p on p.p_partkey = floor((c_custkey % 1000) / cast(0.7 as double))")
def g16_elevation(spark, sf_dir):
    cells = S.table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("cell_x"), F.lit(-3).alias("cell_y"), F.col("p_size").alias("height"))
    rows = S.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 1000).cast("double").alias("mid_coord_lng"), F.lit(-1.5).alias("mid_coord_lat"))
    return spatial.add_height(rows, cells, 0.7).select("c_custkey", "elevation")


@query("s13_poi_snap", f"""with {S.EDGES_SQL}, spots as (select s_suppkey as spot_id, s_suppkey * 4990 % 499000 + cast(33 as double) as x, (s_suppkey % 4) * 20000 + cast(300 as double) as y from supplier),
{S.NEAR_SQL.format(on='abs(e.y1 - s.y) < 25000', where='')} select spot_id, near.line as snapped_line_id, {q_sql('near.measure', 4)} as measure, {q_sql('near.px', 4)} as x, {q_sql('near.py', 4)} as y from near""")
def s13_poi_snap(spark, sf_dir):
    """Named points moved onto the lines without a limit, as points of interest are."""
    k = F.col("s_suppkey")
    named = S.table(spark, sf_dir, "supplier").select(k.alias("spot_id"), G.point(k * 4990 % 499000 + 33.0, (k % 4) * F.lit(20000.0) + 300.0).alias("geometry"))
    return _snapped(spatial.snap(named, stored_edges(spark, sf_dir)))


def switches(spark, sf_dir):
    """Switch points beside the lines, from ``supplier``."""
    k = F.col("s_suppkey")
    return S.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("id"), G.point(k * 1331 % 450000 + 17.0, (k % 4) * F.lit(20000.0) + 250.0 + F.col("s_acctbal") % 170).alias("geometry"))


# The nearest segment is the one that holds the foot point on the nearest edge of the first line within reach.
_SWITCH_SQL = f"""spots as (select s_name as spot_id, s_suppkey * 1331 % 450000 + cast(17 as double) as x, (s_suppkey % 4) * 20000 + cast(250 as double) + s_acctbal % 170 as y from supplier),
{S.NEAR_SQL.format(on='abs(e.y1 - s.y) < 5000', where='')},
hits as (select s.spot_id, case when near.dist <= 100 then near.line end as line_id, near.measure as m from spots s left join near on s.spot_id = near.spot_id),
placed_hits as (select h.spot_id, min_by(p.chainage_id, p.seq) as chainage_id from hits h join spans p on p.line_id = h.line_id and p.a <= h.m and h.m <= p.b group by 1)"""


@query("j5_nearest_switch", f"with {S.EDGES_SQL}, {SEGMENTS_SQL}, {_SWITCH_SQL} select s.spot_id as id, p.chainage_id from spots s left join placed_hits p on s.spot_id = p.spot_id")
def j5_nearest_switch(spark, sf_dir):
    segments = checkpointed(all_segments(spark, sf_dir))
    return spatial.nearest_segment(switches(spark, sf_dir), segments, LINES).select("id", "chainage_id")


@query("j5_nearest_switch_crowded", f"with {S.EDGES_SQL}, {SEGMENTS_SQL}, {_SWITCH_SQL} select s.spot_id as id, p.chainage_id from spots s left join placed_hits p on s.spot_id = p.spot_id")
def j5_nearest_switch_crowded(spark, sf_dir):
    """The same where every cell counts as crowded: lines tried in order, sub-cells split, nothing broadcast."""
    segments = checkpointed(all_segments(spark, sf_dir))
    return spatial.nearest_segment(switches(spark, sf_dir), segments, LINES, cell_edges=0, limit_bytes=0, hot_rows=50).select("id", "chainage_id")


@query("a8_switch_ids", f"with {S.EDGES_SQL}, {SEGMENTS_SQL}, {_SWITCH_SQL} select p.chainage_id, p.line_id, coalesce(string_agg(h.spot_id, ',' order by h.spot_id), '') as switch_ids "
       "from spans p left join placed_hits h on h.chainage_id = p.chainage_id group by 1, 2")
def a8_switch_ids(spark, sf_dir):
    segments = checkpointed(all_segments(spark, sf_dir))
    found = spatial.nearest_segment(switches(spark, sf_dir), segments, LINES)
    return spatial.switch_ids(segments.select("chainage_id", "line_id"), found).select("chainage_id", "line_id", F.array_join("switch_ids", ",").alias("switch_ids"))


def _curves(spark, sf_dir):
    return prepare_sections(S.raw_sections(spark, sf_dir), skip_first_row=True)


# An end's measure follows from its chainage; an end on another line is projected by brute force.
_G17_SQL = f"""{S.EDGES_SQL}, {SEGMENTS_SQL}, {S.RAW_SECTIONS_SQL},
curves as (select *, {S.SECTION_LINE_SQL.format('start_km')} as own from raw_sections where seq <> 0 and section not in ('nan', 'LINE', 'Section') and start_km <> end_km and start_km > 0),
ends as (select section_id, own, section, 0 as is_end, start_km as c from curves union all select section_id, own, section, 1, end_km from curves),
lined as (select *, {S.SECTION_LINE_SQL.format('c')} as line_id from ends),
starts as (select line_id, min(start_hm) / cast(10 as double) as s, max(start_hm + 1) / cast(10 as double) as e, min(shift) as shift from segments group by 1),
measured as (select l.*, case when c between s and e then least((c - s) * 1000 - shift, t.length) end as m from lined l join starts using (line_id) join totals t using (line_id)),
away as (select section_id, is_end, own, x1 + (m - m0) / len * (x2 - x1) as x, y1 + (m - m0) / len * (y2 - y1) as y
  from measured join edges e on e.line_id = measured.line_id and m0 <= m and m < m0 + len where measured.line_id <> own),
projected as (select section_id, is_end, min_by(m, struct_pack(d := d, m := m)) as m from (
  select section_id, is_end, m0 + k * len as m, sqrt((x - x1 - k * (x2 - x1)) * (x - x1 - k * (x2 - x1)) + (y - y1 - k * (y2 - y1)) * (y - y1 - k * (y2 - y1))) as d
  from (select a.*, e.*, least(greatest(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (len * len), cast(0 as double)), cast(1 as double)) as k from away a join edges e on e.line_id = a.own)) group by 1, 2),
final as (select d.section_id, d.own as line_id, d.is_end, case when d.line_id = d.own then d.m else p.m end as m from measured d left join projected p on p.section_id = d.section_id and p.is_end = d.is_end),
ranges as (select section_id, line_id, max(case when is_end = 0 then m end) as a, max(case when is_end = 1 then m end) as b from final group by 1, 2),
both_ends as (select * from ranges where a is not null and b is not null)"""


@query("g17_section_shapes", f"with {_G17_SQL}, {_pieces_sql('both_ends', 'section_id')} select r.line_id, r.section_id, s.vertices, {q_sql('s.length', 2)} as length "
       "from ranges r left join shapes s on s.section_id = r.section_id")
def g17_section_shapes(spark, sf_dir):
    e = stored_edges(spark, sf_dir)
    segments = checkpointed(linear.chainage_segments(e, LINE_CHAINAGES).drop("geometry"))
    built = sec.build_sections(_curves(spark, sf_dir), segments, e)
    return built.select("line_id", "section_id", F.when(F.col("geometry").isNotNull(), F.size("geometry")).cast("long").alias("vertices"), q(G.line_length(F.col("geometry")), 2).alias("length"))


@query("j8_lost_ends", f"with {_G17_SQL} select section_id, is_end as \"end\", line_id from measured where m is null")
def j8_lost_ends(spark, sf_dir):
    segments = checkpointed(all_segments(spark, sf_dir).drop("geometry"))
    return sec.lost_ends(_curves(spark, sf_dir), segments).select("section_id", "end", "line_id")


@query("w1_segment_km", f"with {S.EDGES_SQL}, {SEGMENTS_SQL} select line_id, min(start_hm) as first_hm, max(start_hm) as last_hm, count(*) as n from spans group by 1")
def w1_segment_km(spark, sf_dir):
    return all_segments(spark, sf_dir).groupBy("line_id").agg(F.min("start_hm").alias("first_hm"), F.max("start_hm").alias("last_hm"), F.count(F.lit(1)).alias("n"))


@query("w2_running_distance", f"select o_custkey % 3 as line, o_orderkey as seq, {q_sql('coalesce(sum(o_totalprice) over (partition by o_custkey % 3 order by o_orderkey rows between unbounded preceding and 1 preceding), 0)', 2)} as before from orders")
def w2_running_distance(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 3).alias("line"), F.col("o_orderkey").alias("seq"), "o_totalprice")
    return scale.running_sum(o, ["line"], "seq", "o_totalprice", "before", block=256).select("line", "seq", q(F.col("before"), 2).alias("before"))


@query("f2_poi_by_name", "select p_partkey, cast(case when p_partkey % 2 = 0 then 662669.066 else 664948.312 end as double) as x from part")
def f2_poi_by_name(spark, sf_dir):
    wanted = F.when(F.col("p_partkey") % 2 == 0, "origin").otherwise("mainline_start")
    named = poi(spark).select("name", F.col("geometry.x").alias("x"))
    rows = S.table(spark, sf_dir, "part").select("p_partkey", wanted.alias("name"))
    return scale.lookup_join(rows, named, ["name"], how="inner").select("p_partkey", "x")
