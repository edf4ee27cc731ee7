"""Queries for interval joins, statistics per section, and status."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainmark.constants import SPEED_MEASURES, STATUS_METRICS, STATUS_PARAMS, THRESHOLDS, WEAR_MEASURES
from chainmark.functions.columns import class_key
from chainmark.functions.condition import limit_of, rail_side
from chainmark.operators import intervals, stats
from chainmark.operators.cleaning import unmatched
from chainmark.plans import standins as S
from chainmark.plans.registry import query
from chainmark.plans.standins import q, q_sql

ASSIGNED = f"with {S.SECTIONS_SQL}, {S.RP_SQL}, {S.ASSIGN_SQL.format(name='assigned', points='rp')}"
TG_ASSIGNED = f"{S.TG_SQL}, {S.ASSIGN_SQL.format(name='tg_assigned', points='tg')}"


def assigned(spark, sf_dir):
    return intervals.assign_sections(S.rp_points(spark, sf_dir), S.sections(spark, sf_dir))


def tg_assigned(spark, sf_dir):
    return intervals.assign_sections(S.tg_points(spark, sf_dir), S.sections(spark, sf_dir))


@query("j3_interval_join", ASSIGNED + f"select line_id, section_id, count(*) as n, {q_sql('sum(chainage)', 3)} as km from assigned group by 1, 2")
def j3_interval_join(spark, sf_dir):
    return assigned(spark, sf_dir).groupBy("line_id", "section_id").agg(F.count(F.lit(1)).alias("n"), q(F.sum("chainage"), 3).alias("km"))


@query("j3_interval_join_shuffled", ASSIGNED + "select line_id, section_id, count(*) as n from assigned group by 1, 2")
def j3_interval_join_shuffled(spark, sf_dir):
    """The same join as on a section table too large to broadcast, with busy bins salted."""
    rows = intervals.assign_sections(S.rp_points(spark, sf_dir), S.sections(spark, sf_dir), limit_bytes=0, hot_rows=20)
    return rows.groupBy("line_id", "section_id").agg(F.count(F.lit(1)).alias("n"))


@query("j4_snapped_interval", f"""with {S.SECTIONS_SQL}, {S.RP_SQL},
shifted as (select line_id, (case line_id when 'TLX' then cast(-3.7 as double) when 'MLX' then 26.9 when 'SML' then 174 else 288.7 end) + chainage * 100 / cast(1000 as double) as chainage from rp),
{S.ASSIGN_SQL.format(name='assigned', points='shifted')} select line_id, section_id, count(*) as n from assigned group by 1, 2""")
def j4_snapped_interval(spark, sf_dir):
    rp = S.rp_points(spark, sf_dir).select("line_id", (F.col("chainage") * 100).alias("len_from_line_start"))
    return intervals.assign_sections_by_distance(rp, S.sections(spark, sf_dir)).groupBy("line_id", "section_id").agg(F.count(F.lit(1)).alias("n"))


_SEGMENTS_SQL = f"""segs as (select {S.LINE_SQL.format('p_partkey % 4')} as line_id, 'SEG_' || lpad(cast(p_partkey as varchar), 9, '0') as chainage_id,
  floor(p_partkey / cast(4 as double)) / 2 as s, floor(p_partkey / cast(4 as double)) / 2 + cast(0.5 as double) as e from part),
ats as (select {S.LINE_SQL.format('l_partkey % 4')} as line_id, (l_partkey + l_linenumber * 3) / cast(16 as double) as chainage from lineitem)"""


@query("j2_segment_lookup", f"with {_SEGMENTS_SQL}" + """
select chainage_id, count(*) as n from (select p.line_id, p.chainage, (select min_by(g.chainage_id, struct_pack(a := g.s, b := g.chainage_id)) from segs g
  where g.line_id = p.line_id and g.s <= p.chainage and p.chainage <= g.e) as chainage_id from ats p) group by 1""")
def j2_segment_lookup(spark, sf_dir):
    k = F.col("p_partkey")
    start = F.floor(k / F.lit(4.0)) / F.lit(2.0)
    segs = S.table(spark, sf_dir, "part").select(S.line_name(k % 4).alias("line_id"), F.format_string("SEG_%09d", k).alias("chainage_id"),
                                                 start.alias("chainage_start_km"), (start + F.lit(0.5)).alias("chainage_end_km"))
    at = S.table(spark, sf_dir, "lineitem").select(S.line_name(F.col("l_partkey") % 4).alias("line_id"), ((F.col("l_partkey") + F.col("l_linenumber") * 3) / F.lit(16.0)).alias("chainage"))
    return intervals.find_segments(at, segs).groupBy("chainage_id").agg(F.count(F.lit(1)).alias("n"))


@query("j8_unmatched", ASSIGNED + "select line_id, count(*) as n from assigned where section_id is null group by 1")
def j8_unmatched(spark, sf_dir):
    return unmatched(assigned(spark, sf_dir)).groupBy("line_id").agg(F.count(F.lit(1)).alias("n"))


@query("a9_interval_summary", f"with {S.SECTIONS_SQL} select line_id, count(*) as num_intervals, min_by(section_id, seq) as first_section, max_by(section_id, seq) as last_section, "
       "min_by(start_km, seq) as first_start_km, max_by(end_km, seq) as last_end_km from sections group by 1")
def a9_interval_summary(spark, sf_dir):
    return intervals.interval_summary(S.sections(spark, sf_dir))


_Q9 = f"with flipped as (select p_partkey % 3 as turn, s.* from ({'with ' + S.SECTIONS_SQL + ' select * from sections'}) s join part on p_partkey = seq)"


@query("q9_reversed_sections", _Q9 + " select section_id, line_id from flipped where turn = 0")
def q9_reversed_sections(spark, sf_dir):
    s = S.sections(spark, sf_dir)
    turn = F.col("seq") % 3 == 0
    flipped = s.withColumns({"start_km": F.when(turn, F.col("end_km")).otherwise(F.col("start_km")), "end_km": F.when(turn, F.col("start_km")).otherwise(F.col("end_km"))})
    return intervals.reversed_sections(flipped).select("section_id", "line_id")


def _measure_sql(missing: str = "propagate") -> str:
    out = ["count(*) as num_points"]
    for c, n in WEAR_MEASURES.items():
        out += [f"min({c}) as min_{n}", f"max({c}) as max_{n}", f"cast(sum(cast({c} as decimal(26,12))) as double) / count({c}) as avg_{n}", f"stddev_pop({c}) as std_{n}"]
        for label, p in stats.PROBS.items():
            value = f"quantile_cont({c}, {p})"
            out.append((f"case when count({c}) = count(*) then {value} end" if missing == "propagate" else value) + f" as {label}_{n}")
    return ", ".join(out)


STAT_NAMES = [f"{a}_{n}" for n in WEAR_MEASURES.values() for a in ("min", "max", "avg", "std", "p50", "p75", "p90")]
PCT_NAMES = [f"{a}_{n}" for n in WEAR_MEASURES.values() for a in stats.PROBS]
STATS = ASSIGNED + f", stats as (select section_id, {_measure_sql()} from assigned where section_id is not null group by 1)"


def _on_grid(df, names):
    return df.select("section_id", "num_points", *[q(F.col(n)).alias(n) for n in names])


@query("a1_rp_stats", STATS + "select section_id, num_points, " + ", ".join(f"{q_sql(n)} as {n}" for n in STAT_NAMES) + " from stats")
def a1_rp_stats(spark, sf_dir):
    return _on_grid(stats.rp_stats(assigned(spark, sf_dir)), STAT_NAMES)


@query("a6_percentiles_skip", ASSIGNED + f", stats as (select section_id, {_measure_sql('skip')} from assigned where section_id is not null group by 1) select section_id, num_points, "
       + ", ".join(f"{q_sql(n)} as {n}" for n in PCT_NAMES) + " from stats")
def a6_percentiles_skip(spark, sf_dir):
    return _on_grid(stats.rp_stats(assigned(spark, sf_dir), missing="skip"), PCT_NAMES)


_BY_LINE = STATS.replace("select section_id, count(*)", "select line_id as section_id, count(*)")


@query("a6_percentiles_large_groups", _BY_LINE + "select section_id, num_points, " + ", ".join(f"{q_sql(n, 4)} as {n}" for n in STAT_NAMES) + " from stats")
def a6_percentiles_large_groups(spark, sf_dir):
    """Percentiles of whole lines: groups too large for one task take the distributed ranks."""
    rp = assigned(spark, sf_dir).where("section_id is not null").withColumn("section_id", F.col("line_id"))
    bound = S.table(spark, sf_dir, "lineitem").count()
    found = stats.rp_stats(rp, hot_rows=max(bound // 100, 1))
    return found.select("section_id", "num_points", *[q(F.col(n), 4).alias(n) for n in STAT_NAMES])


SPEEDS = [f"{a}_{c}" for c in SPEED_MEASURES for a in ("min", "avg", "max")]
TG_STATS = "tg_stats as (select section_id, count(*) as num_points, " + ", ".join(f"{a}({c}) as {a}_{c}" for c in SPEED_MEASURES for a in ("min", "avg", "max")) + \
    " from tg_assigned where section_id is not null group by 1)"


@query("a7_tg_stats", f"with {S.SECTIONS_SQL}, {TG_ASSIGNED}, {TG_STATS} select section_id, num_points, " + ", ".join(f"{q_sql(n)} as {n}" for n in SPEEDS) + " from tg_stats")
def a7_tg_stats(spark, sf_dir):
    return _on_grid(stats.tg_stats(tg_assigned(spark, sf_dir)), SPEEDS)


@query("j7_rp_tg_left", ASSIGNED + f", {TG_ASSIGNED}, {TG_STATS}, rp_counts as (select section_id, count(*) as num_points from assigned where section_id is not null group by 1)"
       " select r.section_id, r.num_points, " + ", ".join(f"{q_sql('t.' + n)} as {n}" for n in SPEEDS) + " from rp_counts r left join tg_stats t on r.section_id = t.section_id")
def j7_rp_tg_left(spark, sf_dir):
    rp = stats.in_section(assigned(spark, sf_dir)).groupBy("section_id").agg(F.count(F.lit(1)).alias("num_points"))
    return _on_grid(stats.with_speeds(rp, stats.tg_stats(tg_assigned(spark, sf_dir))), SPEEDS)


def _limit_sql(param: str, track: str) -> str:
    lo, hi = ("RH", "LH") if track == "w" else ("LH", "RH")
    whens = []
    for name, limits in THRESHOLDS.items():
        v = limits[param]
        if isinstance(v, dict):
            v = f"case when hand is null or hand = '{lo}' then {v['lo']} when hand = '{hi}' then {v['hi']} end"
        whens.append(f"when '{name}' then cast({v} as double)")
    return f"(case lower(replace(classification, ' ', '_')) {' '.join(whens)} end)"


@query("t1_t2_limits", f"with {S.SECTIONS_SQL} select section_id, " + ", ".join(f"{_limit_sql(p, t)} as limit_{t}_{p}" for t in "we" for p in STATUS_PARAMS)
       + ", case when hand is null or hand = 'RH' then 'lo' else 'hi' end as west_side from sections")
def t1_t2_limits(spark, sf_dir):
    limits = [limit_of(class_key(F.col("classification")), p, F.col("hand"), t).alias(f"limit_{t}_{p}") for t in "we" for p in STATUS_PARAMS]
    return S.sections(spark, sf_dir).select("section_id", *limits, rail_side(F.col("hand"), "w").alias("west_side"))


FLAGS = [f"status_{m}_{t}_{p}" for m in STATUS_METRICS for t in "ew" for p in STATUS_PARAMS]
FLAGGED = STATS + ", flagged as (select st.section_id, st.num_points, " + ", ".join(
    f"case when st.{m}_{t}_{p} > {_limit_sql(p, t)} then 'exceeds' else '' end as status_{m}_{t}_{p}"
    for m in STATUS_METRICS for t in "ew" for p in STATUS_PARAMS) + " from stats st join sections s on s.section_id = st.section_id)"


def _colour_sql(t: str, p: str) -> str:
    return f"case when status_p90_{t}_{p} = 'exceeds' and status_p75_{t}_{p} = 'exceeds' then 'R' when status_p90_{t}_{p} = 'exceeds' then 'A' else 'G' end"


STATUS = FLAGGED + ", coded as (select section_id, num_points, " + " || ".join(
    ["(" + _colour_sql("w", p) + ")" for p in STATUS_PARAMS] + ["'-'"] + ["(" + _colour_sql("e", p) + ")" for p in STATUS_PARAMS]) + " as status_string from flagged)"
SCORED = STATUS + """, scored as (select section_id, num_points, status_string,
  case when strpos(status_string, 'R') > 0 then 'R' when strpos(status_string, 'A') > 0 then 'A' else 'G' end as status_level,
  cast(length(status_string) - length(replace(status_string, 'A', '')) + 3 * (length(status_string) - length(replace(status_string, 'R', ''))) as integer) as status_score from coded)"""


def with_status(spark, sf_dir):
    sections = S.sections(spark, sf_dir)
    found = stats.rp_stats(intervals.assign_sections(S.rp_points(spark, sf_dir), sections))
    return stats.with_status(stats.with_section(found, sections))


@query("t3_flags", FLAGGED + " select * from flagged")
def t3_flags(spark, sf_dir):
    return with_status(spark, sf_dir).select("section_id", "num_points", *FLAGS)


@query("t5_status", SCORED + " select * from scored")
def t5_status(spark, sf_dir):
    return with_status(spark, sf_dir).select("section_id", "num_points", "status_string", "status_level", "status_score")


@query("t7_score_rank", SCORED + " select section_id, status_score, status_level from scored")
def t7_score_rank(spark, sf_dir):
    """Score and level of every section."""
    return with_status(spark, sf_dir).select("section_id", "status_score", "status_level")


@query("q19_unclassified", f"with {S.SECTIONS_SQL} select section_id from sections where seq % 11 = 0 or (hand is not null and seq % 13 = 0)")
def q19_unclassified(spark, sf_dir):
    s = S.sections(spark, sf_dir)
    s = s.withColumn("classification", F.when(F.col("seq") % 11 == 0, "Spiral").otherwise(F.col("classification")))
    return stats.unclassified(s.withColumn("hand", F.when(F.col("hand").isNotNull() & (F.col("seq") % 13 == 0), "??").otherwise(F.col("hand")))).select("section_id")
