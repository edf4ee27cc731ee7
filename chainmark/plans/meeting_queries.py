"""Queries on lines that meet: crossings and joints, cutting there, parts merged end to end, and overlaps taken together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainmark.functions.geometry import line_length, point
from chainmark.operators import covering, gaps, linear, merging, noding
from chainmark.plans.registry import query
from chainmark.plans.standins import q, q_sql, table
from chainmark.session import checkpointed

#: Legs of the lines of ``street_vertices``: along the lattice, across it, and back over themselves.
_FIRST = [(40, 0), (0, 40), (40, 40), (30, -20), (0, -50)]
_SECOND = [(0, 30), (30, 0), (-20, 20), (10, -30), (50, 10), (-40, 0), (20, 20)]


def _pick(values, number):
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (number % len(values) + 1).cast("int"))


def _pick_sql(values, number):
    return f"list_extract({[float(v) for v in values]}, ({number} % {len(values)} + 1)::BIGINT)"


def street_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of two edges for each customer, on a lattice that 300 of them share: many cross, touch or overlap."""
    k = F.col("c_custkey")
    x, y = F.floor(k / 300) * 1000.0 + (k * 37 % 40) * 10, (k * 53 % 40) * 10.0
    a, b = (_pick([v[i] for v in _FIRST], k) for i in (0, 1))
    c, d = (_pick([v[i] for v in _SECOND], k) for i in (0, 1))
    pts = F.array(point(x, y), point(x + a, y + b), point(x + a + c, y + b + d))
    return table(spark, sf_dir, "customer").select(k.alias("line_id"), pts.alias("pts"))


_STREETS = f"""s as (select c_custkey as k, floor(c_custkey / 300) * 1000.0 + (c_custkey * 37 % 40) * 10 as x, (c_custkey * 53 % 40) * 10.0 as y,
  {_pick_sql([v[0] for v in _FIRST], 'c_custkey')} as a, {_pick_sql([v[1] for v in _FIRST], 'c_custkey')} as b,
  {_pick_sql([v[0] for v in _SECOND], 'c_custkey')} as c, {_pick_sql([v[1] for v in _SECOND], 'c_custkey')} as d from customer),
e as (select k, 0 as seq, x::double as x1, y::double as y1, (x + a)::double as x2, (y + b)::double as y2, 0.0::double as m0, sqrt(a * a + b * b) as m1 from s
  union all select k, 1, x + a, y + b, x + a + c, y + b + d, sqrt(a * a + b * b), sqrt(a * a + b * b) + sqrt(c * c + d * d) from s),
spots as (select x1 as x, y1 as y from e union select x2, y2 from e),
inc as (select distinct k, x, y, round(case when x = x1 and y = y1 then m0 when x = x2 and y = y2 then m1
    else m0 + ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2) * (m1 - m0) end, 7) as m
  from e join spots on x between least(x1, x2) and greatest(x1, x2) and y between least(y1, y2) and greatest(y1, y2)
    and (x2 - x1) * (y - y1) = (y2 - y1) * (x - x1)),
busy as (select x, y from inc group by x, y having count(*) > 1),
sides as (select e, f, (e.x2 - e.x1) * (f.y1 - e.y1) - (e.y2 - e.y1) * (f.x1 - e.x1) as p, (e.x2 - e.x1) * (f.y2 - e.y1) - (e.y2 - e.y1) * (f.x2 - e.x1) as r,
    (f.x2 - f.x1) * (e.y1 - f.y1) - (f.y2 - f.y1) * (e.x1 - f.x1) as u, (f.x2 - f.x1) * (e.y2 - f.y1) - (f.y2 - f.y1) * (e.x2 - f.x1) as v
  from e join e f on (e.k < f.k or (e.k = f.k and e.seq < f.seq)) and e.x1 between f.x1 - 200 and f.x1 + 200),
crossed as (select *, u / (u - v) as t, p / (p - r) as w from sides where p * r < 0 and u * v < 0),
cuts as (select k, m, x, y from inc semi join busy using (x, y)
  union select e.k, round(e.m0 + t * (e.m1 - e.m0), 7), e.x1 + t * (e.x2 - e.x1), e.y1 + t * (e.y2 - e.y1) from crossed
  union select f.k, round(f.m0 + w * (f.m1 - f.m0), 7), e.x1 + t * (e.x2 - e.x1), e.y1 + t * (e.y2 - e.y1) from crossed)"""


@query("g18_crossings", f"with {_STREETS} select distinct k as line_id, {q_sql('m', 3)} as measure, {q_sql('x', 3)} as x, {q_sql('y', 3)} as y from cuts")
def g18_crossings(spark, sf_dir):
    edges = checkpointed(linear.edge_table(street_vertices(spark, sf_dir)))
    return noding.crossings(edges).select("line_id", *[q(F.col(c), 3).alias(c) for c in ("measure", "x", "y")])


@query("g18_split_at_crossings", f"""with {_STREETS},
inner_cuts as (select distinct k, {q_sql('m', 3)} as m from cuts join (select k as k2, max(m1) as len from e group by k) on k = k2 where m > 0.001 and m < len - 0.001),
starts as (select k, m as a from inner_cuts union select k, {q_sql('0.0::double', 3)} from s)
select k as line_id, row_number() over w - 1 as piece, a, coalesce(lead(a) over w, len) as b
from starts join (select k as k2, {q_sql('max(m1)', 3)} as len from e group by k) on k = k2 window w as (partition by k order by a)""")
def g18_split_at_crossings(spark, sf_dir):
    edges = checkpointed(linear.edge_table(street_vertices(spark, sf_dir)))
    return noding.split_at_crossings(edges).select("line_id", "piece", q(F.col("a"), 3).alias("a"), q(F.col("b"), 3).alias("b"))


def line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part of two edges for each customer: chains with breaks, forks, rings and loops, every third part turned round."""
    k = F.col("c_custkey")

    def place(n):
        return point(n * 10.0, (n * 7 % 11) * 5.0)

    start = F.when(k % 25 == 0, point(k * 10.0, F.lit(999.0))).when(k % 40 == 7, place(k - 3)).otherwise(place(k))
    end = F.when(k % 50 == 39, point(k * 10.0, F.lit(777.0))).when(k % 50 == 44, place(k - 4)).when(k % 60 == 58, place(k - 4)).otherwise(place(k + 1))
    pts = F.array(start, point(k * 10.0 + 5, (k % 3).cast("double")), end)
    return table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 3 == 0, F.reverse(pts)).otherwise(pts).alias("pts"))


def _place_sql(n):
    return f"{{'x': ({n}) * 10.0::double, 'y': (({n}) * 7 % 11) * 5.0::double}}"


@query("g19_merged_lines", f"""with recursive p as (select c_custkey as id, c_custkey % 3 = 0 as turned,
    case when c_custkey % 25 = 0 then {{'x': c_custkey * 10.0::double, 'y': 999.0::double}} when c_custkey % 40 = 7 then {_place_sql('c_custkey - 3')} else {_place_sql('c_custkey')} end as s,
    {{'x': c_custkey * 10.0::double + 5, 'y': (c_custkey % 3)::double}} as m,
    case when c_custkey % 50 = 39 then {{'x': c_custkey * 10.0::double, 'y': 777.0::double}} when c_custkey % 50 = 44 then {_place_sql('c_custkey - 4')}
      when c_custkey % 60 = 58 then {_place_sql('c_custkey - 4')} else {_place_sql('c_custkey + 1')} end as t from customer),
parts as (select id, case when turned then t else s end as s, m, case when turned then s else t end as t from p),
ends as (select id, false as far, s as spot from parts union all select id, true, t from parts),
meet as (select min({{'id': id, 'far': far}}) as p, max({{'id': id, 'far': far}}) as r from ends group by spot having count(*) = 2),
succ as (select p.id as id, not p.far as back, r.id as nid, r.far as nback from meet union all select r.id, not r.far, p.id, p.far from meet),
states as (select id, b as back from parts, (values (false), (true)) v(b)),
heads as (select id, back from states anti join (select nid as id, nback as back from succ) using (id, back)),
walk as (select id as h, back as hb, id, back, 0 as pos from heads
  union all select h, hb, nid, nback, pos + 1 from walk join succ on walk.id = succ.id and walk.back = succ.back),
ringed as (select id as h, id, back, 0 as pos from (select id, back from states anti join walk using (id, back)) where not back
  union all select h, nid, nback, pos + 1 from ringed join succ on ringed.id = succ.id and ringed.back = succ.back where nid <> h),
every as (select 'c' || h || hb as w, id, back, pos from walk union all select 'r' || h, id, back, pos from ringed),
low as (select w, min(id) as low, max(pos) as most from every group by w),
chosen as (select low as chain, every.* from every join low using (w) where w in (
  select w from every join low using (w) where id = low and not back and (w like 'c%' or pos = 0)))
select chain, count(*) as parts, {q_sql('sum(sqrt((s.x - m.x) ** 2 + (s.y - m.y) ** 2) + sqrt((t.x - m.x) ** 2 + (t.y - m.y) ** 2))', 3)} as length,
  min_by(case when back then t.x else s.x end, pos) as x1, min_by(case when back then t.y else s.y end, pos) as y1,
  max_by(case when back then s.x else t.x end, pos) as x2, max_by(case when back then s.y else t.y end, pos) as y2
from chosen join parts on parts.id = chosen.id group by chain""")
def g19_merged_lines(spark, sf_dir):
    lines = merging.merge_lines(line_parts(spark, sf_dir))
    first, last = F.get("pts", F.lit(0)), F.get("pts", F.size("pts") - 1)
    return lines.select("chain", "parts", q(line_length(F.col("pts")), 3).alias("length"),
                        first["x"].alias("x1"), first["y"].alias("y1"), last["x"].alias("x2"), last["y"].alias("y2"))


_CARRIED = f"""{_STREETS[:_STREETS.index('spots as')]}g as (select *, gcd((x2 - x1)::bigint, (y2 - y1)::bigint) * case when x2 > x1 or (x2 = x1 and y2 > y1) then 1 else -1 end as g from e),
on_line as (select ((x2 - x1) / g)::bigint as ux, ((y2 - y1) / g)::bigint as uy, ((x2 - x1) / g * y1 - (y2 - y1) / g * x1)::bigint as o,
  case when x1 = x2 then y1 else x1 end as p, case when x1 = x2 then y2 else x2 end as r from g),
ends as (select ux, uy, o, least(p, r) as s, 1 as d from on_line union all select ux, uy, o, greatest(p, r), -1 from on_line),
changes as (select ux, uy, o, s, sum(d) as d from ends group by all),
counted as (select *, sum(d) over w as n, lead(s) over w as t from changes window w as (partition by ux, uy, o order by s))"""
_AT = "case when ux = 0 then -o else {0} end::double as x{1}, case when ux = 0 then {0} else (o + uy * {0}) / ux end::double as y{1}"


@query("g20_cover_counts", f"with {_CARRIED} select {_AT.format('s', 1)}, {_AT.format('t', 2)}, n::bigint as covers from counted where n > 0")
def g20_cover_counts(spark, sf_dir):
    return covering.cover_counts(checkpointed(linear.edge_table(street_vertices(spark, sf_dir))))


@query("g20_union_of_lines", f"""with {_CARRIED},
bounds as (select *, n - d as before, lead(s) over (partition by ux, uy, o order by s) as u from counted where n = 0 or n - d = 0)
select {_AT.format('s', 1)}, {_AT.format('u', 2)} from bounds where before = 0""")
def g20_union_of_lines(spark, sf_dir):
    return covering.union_lines(checkpointed(linear.edge_table(street_vertices(spark, sf_dir))))


def street_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return street_vertices(spark, sf_dir).withColumnRenamed("line_id", "id")


_GAP, _REACH = 25.0, 35.0
# The nearest pair of each block of 300 lines, then the nearest of what is left, and so on; blocks lie far apart.
_TAKEN = f"""recursive {_STREETS[:_STREETS.index('e as (')]}
ends as (select k, false as far, x::double as x, y::double as y from s union all select k, true, x + a + c, y + b + d from s),
single as (select min({{'id': k, 'far': far}}) as e, x, y from ends group by x, y having count(*) = 1),
pairs as (select floor(a.e.id / 300) as blk, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) as square, a.e as e, a.x as x, a.y as y, b.e as f, b.x as fx, b.y as fy
  from single a join single b on a.e < b.e and a.e.id <> b.e.id and b.x between a.x - 30 and a.x + 30),
ranked as (select *, row_number() over (partition by blk order by square, md5(concat_ws('|', e.id, e.far, f.id, f.far)), e, f) as i from pairs where square <= {_GAP ** 2}),
walk as (select blk, 0::bigint as i, list_value(e)[2:] as used, false as took from ranked where i = 1
  union all select w.blk, r.i, case when list_has_any(w.used, [r.e, r.f]) then w.used else list_concat(w.used, [r.e, r.f]) end, not list_has_any(w.used, [r.e, r.f])
  from walk w join ranked r on r.blk = w.blk and r.i = w.i + 1),
taken as (select ranked.* from ranked join walk using (blk, i) where took)"""


@query("g21_gaps", f"""with {_TAKEN} select e.id as id, e.far as far, x, y, f.id as other, f.far as other_far, fx as other_x, fy as other_y, {q_sql('sqrt(square)', 6)} as gap from taken""")
def g21_gaps(spark, sf_dir):
    return gaps.gaps(street_parts(spark, sf_dir), _GAP).withColumn("gap", q(F.col("gap"), 6))


@query("g21_closed_gaps", f"""with {_TAKEN}, added as (select e.id as k, count(*) as n, sum(sqrt(square)) as d from taken group by 1)
select k as id, 3 + coalesce(n, 0) as vertices, {q_sql('sqrt(a * a + b * b) + sqrt(c * c + d1 * d1) + coalesce(added.d, 0.0)', 6)} as length
from (select k, a, b, c, d as d1 from s) left join added using (k)""")
def g21_closed_gaps(spark, sf_dir):
    closed = gaps.close_gaps(street_parts(spark, sf_dir), _GAP)
    return closed.select("id", F.size("pts").cast("long").alias("vertices"), q(line_length(F.col("pts")), 6).alias("length"))


_UNIT = 1e6
_HITS = f"""{_STREETS[:_STREETS.index('spots as')]}
g as (select k, seq, m0, m1, round(x1 * {_UNIT})::bigint as px, round(y1 * {_UNIT})::bigint as py, round(x2 * {_UNIT})::bigint as qx, round(y2 * {_UNIT})::bigint as qy from e),
ends as (select k, false as far, seq as own, px as ax, py as ay, qx as ox, qy as oy from g where seq = 0 union all select k, true, seq, qx, qy, px, py from g where seq = 1),
single as (select ends.* from ends join (select ax, ay from ends group by ax, ay having count(*) = 1) using (ax, ay)),
lens as (select *, (ax - ox)::double as ux, (ay - oy)::double as uy from single),
rays as (select k as id, far, own, ax, ay, ax + round({_REACH * _UNIT} * ux / sqrt(ux * ux + uy * uy))::bigint as rx, ay + round({_REACH * _UNIT} * uy / sqrt(ux * ux + uy * uy))::bigint as ry from lens),
met as (select *, (rx - ax)::double as dx, (ry - ay)::double as dy,
    sign((rx - ax)::hugeint * (py - ay) - (ry - ay)::hugeint * (px - ax)) as s_p, sign((rx - ax)::hugeint * (qy - ay) - (ry - ay)::hugeint * (qx - ax)) as s_q,
    (qx - px)::double * (ay - py)::double - (qy - py)::double * (ax - px)::double as here, (qx - px)::double * (ry - py)::double - (qy - py)::double * (rx - px)::double as there,
    sign((qx - px)::hugeint * (ay - py) - (qy - py)::hugeint * (ax - px)) as s_a, sign((qx - px)::hugeint * (ry - py) - (qy - py)::hugeint * (rx - px)) as s_b
  from rays join g on (g.k <> id or g.seq <> own) and least(px, qx) <= greatest(ax, rx) and least(ax, rx) <= greatest(px, qx) and least(py, qy) <= greatest(ay, ry) and least(ay, ry) <= greatest(py, qy)),
shares as (select *, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy) as t_p, ((qx - ax) * dx + (qy - ay) * dy) / (dx * dx + dy * dy) as t_q,
    least(greatest(here / nullif(here - there, 0), 0), 1) as t_c from met where s_p * s_q <= 0 and s_a * s_b <= 0),
hits as (select *, case when s_a = 0 and not (s_p = 0 and s_q = 0) or (s_p = 0 and s_q = 0 and least(t_p, t_q) <= 0) then {{'t': 0.0::double, 'x': ax, 'y': ay}}
    when s_p = 0 and (s_q <> 0 or t_p <= t_q) then {{'t': t_p, 'x': px, 'y': py}} when s_q = 0 then {{'t': t_q, 'x': qx, 'y': qy}}
    else {{'t': t_c, 'x': ax + round(t_c * dx)::bigint, 'y': ay + round(t_c * dy)::bigint}} end as h from shares),
nearest as (select id, far, ax, ay, min({{'t': h.t, 'k': k, 'seq': seq, 'x': h.x, 'y': h.y, 'd': sqrt(dx * dx + dy * dy), 'end': (h.x = px and h.y = py) or (h.x = qx and h.y = qy)}}) as m
  from hits group by all having not (m['x'] = ax and m['y'] = ay))"""


@query("g22_end_extensions", f"""with {_HITS} select id as line_id, far, ax / {_UNIT} as x, ay / {_UNIT} as y, m.k as onto, m.seq::bigint as onto_seq,
{q_sql('m.x / 1e6', 3)} as hit_x, {q_sql('m.y / 1e6', 3)} as hit_y, {q_sql('m.t * m.d / 1e6', 3)} as reach from nearest""")
def g22_end_extensions(spark, sf_dir):
    edges = checkpointed(linear.edge_table(street_vertices(spark, sf_dir)))
    found = gaps.end_extensions(edges, _REACH)
    return found.select("line_id", "far", "x", "y", "onto", "onto_seq", *[q(F.col(c), 3).alias(c) for c in ("hit_x", "hit_y", "reach")])


@query("g22_extended_lines", f"""with {_HITS}, longer as (select id as k, count(*) as n, sum(m.t * m.d / 1e6) as r from nearest group by 1),
added as (select k, count(*) as n from (select distinct m.k as k, m.seq, m.x, m.y from nearest where not m.end) group by 1)
select s.k as line_id, 3 + coalesce(longer.n, 0) + coalesce(added.n, 0) as vertices, {q_sql('sqrt(a * a + b * b) + sqrt(c * c + d * d) + coalesce(r, 0.0)', 3)} as length
from s left join longer using (k) left join added using (k)""")
def g22_extended_lines(spark, sf_dir):
    lines = gaps.extend_ends(street_vertices(spark, sf_dir), _REACH)
    return lines.select("line_id", F.size("pts").cast("long").alias("vertices"), q(line_length(F.col("pts")), 3).alias("length"))
