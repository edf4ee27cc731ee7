"""Domain tables derived from the driver's tables, each as a DataFrame and as the same thing in SQL.

Every derivation is plain arithmetic on key columns, so the tables grow with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainmark.operators.scale import lookup_join, numbered

LINE_NAMES = ["TLX", "MLX", "SML", "EML"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_name(number):
    expr = F.when(number == 0, LINE_NAMES[0])
    for i, name in enumerate(LINE_NAMES[1:], start=1):
        expr = expr.when(number == i, name)
    return expr


LINE_SQL = "(case {0} when 0 then 'TLX' when 1 then 'MLX' when 2 then 'SML' else 'EML' end)"


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curve and tangent sections, disjoint and overlapping, from ``part``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    key = F.col("p_partkey")
    km = F.floor(key / F.lit(4.0)).cast("double")
    kind = (
        F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), "Tangent")
        .when(F.col("p_type").isin("MEDIUM", "PROMO"), "Mild Curve").otherwise("Sharp Curve")
    )
    return p.select(
        F.concat(F.lit("CV_"), key.cast("string")).alias("section_id"),
        key.alias("seq"),
        line_name(key % 4).alias("line_id"),
        km.alias("start_km"),
        (km + F.col("p_size") / F.lit(40.0)).alias("end_km"),
        kind.alias("classification"),
        F.when(kind == "Tangent", F.lit(None).cast("string"))
        .when(F.floor(key / F.lit(8.0)) % 2 == 0, "RH").otherwise("LH").alias("hand"),
    )


SECTIONS_SQL = f"""sections as (
  select 'CV_' || cast(p_partkey as varchar) as section_id, p_partkey as seq,
    {LINE_SQL.format('p_partkey % 4')} as line_id,
    cast(floor(p_partkey / cast(4 as double)) as double) as start_km,
    cast(floor(p_partkey / cast(4 as double)) as double) + p_size / cast(40 as double) as end_km,
    case when p_type in ('ECONOMY', 'STANDARD') then 'Tangent'
      when p_type in ('MEDIUM', 'PROMO') then 'Mild Curve' else 'Sharp Curve' end as classification,
    case when p_type in ('ECONOMY', 'STANDARD') then null
      when floor(p_partkey / cast(8 as double)) % 2 = 0 then 'RH' else 'LH' end as hand
  from part)"""


def rp_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rail profile measurements from ``lineitem``; one in 97 misses its east vertical wear."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    major = F.floor(F.col("l_partkey") / F.lit(4.0))
    minor = (F.col("l_linenumber") * 137 + F.col("l_suppkey") * 71) % 1000
    return li.select(
        line_name(F.col("l_partkey") % 4).alias("line_id"),
        major.cast("int").alias("major"), minor.cast("double").alias("minor"),
        (major + minor / F.lit(1000.0)).alias("chainage"),
        F.when((F.col("l_suppkey") * 7 + F.col("l_linenumber")) % 97 != 0, F.col("l_quantity") / F.lit(2.5)).alias("east_vertical_wear"),
        (F.col("l_tax") * 250).alias("west_vertical_wear"),
        (F.col("l_discount") * 80).alias("east_gauge_side_wear"),
        ((F.col("l_quantity") * F.col("l_linenumber")) % 9).alias("west_gauge_side_wear"),
        ((F.col("l_extendedprice") % 5000) / 100).alias("east_relative_head_loss"),
        ((F.col("l_extendedprice") * 3 % 5000) / 100).alias("west_relative_head_loss"),
    )


RP_SQL = f"""rp as (
  select {LINE_SQL.format('l_partkey % 4')} as line_id,
    cast(floor(l_partkey / cast(4 as double)) as integer) as major,
    cast((l_linenumber * 137 + l_suppkey * 71) % 1000 as double) as minor,
    floor(l_partkey / cast(4 as double)) + ((l_linenumber * 137 + l_suppkey * 71) % 1000) / cast(1000 as double) as chainage,
    case when (l_suppkey * 7 + l_linenumber) % 97 <> 0 then l_quantity / cast(2.5 as double) end as east_vertical_wear,
    l_tax * 250 as west_vertical_wear, l_discount * 80 as east_gauge_side_wear,
    (l_quantity * l_linenumber) % 9 as west_gauge_side_wear,
    (l_extendedprice % 5000) / 100 as east_relative_head_loss,
    (l_extendedprice * 3 % 5000) / 100 as west_relative_head_loss
  from lineitem)"""


def tg_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track geometry measurements (speeds) from ``events``, spread over the lines' sections."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    km = (F.col("event_id") % 503 + (F.col("user_id") % 1000) / F.lit(1000.0))
    return e.select(
        F.col("event_id"), line_name(F.col("event_id") % 4).alias("line_id"), km.alias("chainage"),
        F.col("value").alias("speed"), (F.col("value") * F.lit(1.1)).alias("post_speed"),
    )


TG_SQL = f"""tg as (
  select event_id, {LINE_SQL.format('event_id % 4')} as line_id,
    event_id % 503 + (user_id % 1000) / cast(1000 as double) as chainage,
    value as speed, value * cast(1.1 as double) as post_speed
  from events)"""

REGION_PICKS = ["Thomas", "Jones to CCK", "Firetail", "Future", "Nunna-2", "Unknown Yard", "De Grey", "Avon", "Bow", "MLB", "Eliwana"]
CODE_PICKS = ["MLB", "MLW", "SLB", "SLW", "SLE", "ELB", "MLE", "PTE", "ZZZ"]


def _pick(names, number):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names) + 1).cast("int"))


def raw_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned measurements: region, line code and number joined in one id, from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    text = F.concat_ws("_", _pick(REGION_PICKS, F.col("l_partkey") + F.col("l_linenumber")),
                       _pick(CODE_PICKS, F.col("l_suppkey") + F.col("l_orderkey")), F.col("l_orderkey").cast("string"))
    return li.select(
        F.when(F.col("l_orderkey") % 1009 == 0, "Loose").otherwise(text).alias("id"),
        (F.col("l_partkey") % 60).cast("int").alias("major"),
        (F.col("l_linenumber") * 137 % 1000).cast("double").alias("minor"),
    )


def _pick_sql(names, number):
    cases = " ".join(f"when {i} then '{n}'" for i, n in enumerate(names))
    return f"(case ({number}) % {len(names)} {cases} end)"


RAW_SQL = f"""raw as (
  select case when l_orderkey % 1009 = 0 then 'Loose' else
      {_pick_sql(REGION_PICKS, 'l_partkey + l_linenumber')} || '_' || {_pick_sql(CODE_PICKS, 'l_suppkey + l_orderkey')}
      || '_' || cast(l_orderkey as varchar) end as id,
    cast(l_partkey % 60 as integer) as major, cast(l_linenumber * 137 % 1000 as double) as minor
  from lineitem)"""

REPAIRED_SQL = "replace(replace(id, 'Jones to CCK_MLE', 'Jones to CCK_MLB'), 'Jones to CCK', 'Jones')"
LINE_OF_ID_SQL = """(case
  when region = 'Thomas' and code = 'MLW' then case when chainage <= cast(26.9 as double) then 'TLX' else 'MLX' end
  when region = 'Firetail' and code = 'ELB' then 'SML'
  when region = 'Future' and code = 'SLB' then 'EML'
  when code in ('MLB', 'MLW') then 'MLX'
  when code in ('SLB', 'SLW', 'SLE') then 'SML'
  when code = 'ELB' then 'EML' else 'OTH' end)"""
CLEAN_SQL = f"""{RAW_SQL}, repaired as (select {REPAIRED_SQL} as id, major, minor from raw),
parts as (select id, major, minor, split_part(id, '_', 1) as region,
    case when strpos(id, '_') > 0 then split_part(id, '_', 2) end as code,
    major + minor / cast(1000 as double) as chainage from repaired),
clean as (select id, region as line_region, code, chainage, {LINE_OF_ID_SQL} as line_id from parts)"""

# A section holds a point when start <= chainage < end; of several the first by (start, id) wins.
ASSIGN_SQL = """{name} as (
  select p.*, (select min_by(s.section_id, struct_pack(a := s.start_km, b := s.section_id)) from sections s
    where s.line_id = p.line_id and s.start_km <= p.chainage and p.chainage < s.end_km) as section_id
  from {points} p)"""


# Engines add floats in different orders. Cells of the grid begin away from short decimals, so that a value such
# as 0.5 of the last digit does not fall on a border by rounding noise alone.
SHIFT = 0.4987654321


def q(col, digits: int = 6):
    """A float on a fixed grid, the same in both engines."""
    unit = float(10 ** digits)
    return F.floor(col * F.lit(unit) + F.lit(SHIFT)) / F.lit(unit)


def q_sql(text: str, digits: int = 6) -> str:
    return f"(floor(({text}) * 1e{digits} + cast({SHIFT} as double)) / 1e{digits})"


def raw_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An uncleaned curve table with header-like rows, text numbers and rows without length, from ``part``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    k = F.col("p_partkey")
    start = k / F.lit(8.0) - F.lit(10.0)
    end = F.when(k % 19 == 0, start).otherwise(start + F.col("p_size") / F.lit(50.0))
    return p.select(
        F.concat(F.lit("CB_CV_"), k.cast("string")).alias("Asset Name"),
        _pick(["SL", "EL", "ML", "LINE", "nan", "Section", "MN"], k).alias("Section"),
        F.when(k % 23 == 0, "n/a").otherwise(start.cast("string")).alias("Start Chainage (km)"),
        end.cast("string").alias("End Chainage (km)"),
        F.when(F.col("p_type") == "ECONOMY", "Tangent").otherwise("Mild Curve").alias("Classification"),
        k.alias("Seq"),
    )


RAW_SECTIONS_SQL = f"""raw_sections as (
  select 'CB_CV_' || cast(p_partkey as varchar) as section_id,
    {_pick_sql(["SL", "EL", "ML", "LINE", "nan", "Section", "MN"], 'p_partkey')} as section,
    case when p_partkey % 23 <> 0 then p_partkey / cast(8 as double) - 10 end as start_km,
    case when p_partkey % 19 = 0 then p_partkey / cast(8 as double) - 10
      else p_partkey / cast(8 as double) - 10 + p_size / cast(50 as double) end as end_km,
    case when p_type = 'ECONOMY' then 'Tangent' else 'Mild Curve' end as classification, p_partkey as seq
  from part)"""
SECTION_LINE_SQL = "(case when section = 'SL' then 'SML' when section = 'EL' then 'EML' when {0} <= cast(26.9 as double) then 'TLX' else 'MLX' end)"


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zigzag centreline vertices, 1 km apart along x, from ``part``."""
    k = F.col("p_partkey")
    seq = F.floor(k / F.lit(4.0))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size").select(
        line_name(k % 4).alias("line_id"), seq.alias("seq"),
        (seq * F.lit(1000.0)).alias("x"), ((k % 4) * F.lit(20000.0) + (F.col("p_size") * 17 % 50) * F.lit(10.0)).alias("y"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vertex list per line."""
    return vertices(spark, sf_dir).groupBy("line_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("pts"))


def line_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vertices of ``lines`` as rows: ``seq`` from 0 along their line, of ``n``; no task holds a line."""
    v = numbered(vertices(spark, sf_dir), ["line_id", "seq", "x", "y"], "_id").drop("seq")
    ends = v.groupBy("line_id").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("n"))
    return lookup_join(v, ends, ["line_id"], how="inner").select("line_id", (F.col("_id") - F.col("_first")).alias("seq"), "n", "x", "y")


EDGES_SQL = f"""vertices as (
  select {LINE_SQL.format('p_partkey % 4')} as line_id, cast(floor(p_partkey / cast(4 as double)) as bigint) as seq,
    floor(p_partkey / cast(4 as double)) * cast(1000 as double) as x,
    (p_partkey % 4) * cast(20000 as double) + (p_size * 17 % 50) * cast(10 as double) as y
  from part),
legs as (
  select line_id, seq, x as x1, y as y1, lead(x) over w as x2, lead(y) over w as y2 from vertices
  window w as (partition by line_id order by seq)),
sized as (select *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as len from legs where x2 is not null),
edges as (
  select line_id, seq, x1, y1, x2, y2, len,
    coalesce(sum(len) over (partition by line_id order by seq rows between unbounded preceding and 1 preceding), 0) as m0
  from sized),
totals as (select line_id, sum(len) as length from sized group by line_id)"""


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions scattered beside the lines, from ``customer``."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").select(
        k.alias("spot_id"), line_name(k % 4).alias("line_id"),
        F.struct((k * 331.5 % 499000).alias("x"),
                 ((k % 4) * F.lit(20000.0) + F.lit(250.0) + (F.col("c_acctbal") * 7 % 900) - F.lit(450.0)).alias("y")).alias("geometry"))


SPOTS_SQL = f"""spots as (
  select c_custkey as spot_id, {LINE_SQL.format('c_custkey % 4')} as line_id,
    c_custkey * cast(331.5 as double) % 499000 as x,
    (c_custkey % 4) * cast(20000 as double) + 250 + (c_acctbal * 7 % 900) - 450 as y
  from customer)"""

# Nearest position on any edge of the row's own line (own = true) or of any line, by brute force.
NEAR_SQL = """feet as (
  select s.spot_id, e.line_id, e.seq, e.m0, e.len, e.x1, e.y1, e.x2, e.y2, s.x, s.y,
    least(greatest(((s.x - e.x1) * (e.x2 - e.x1) + (s.y - e.y1) * (e.y2 - e.y1))
      / ((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1)), cast(0 as double)), cast(1 as double)) as t
  from spots s join edges e on {on}),
placed as (
  select *, x1 + t * (x2 - x1) as px, y1 + t * (y2 - y1) as py, m0 + t * len as measure from feet),
near as (
  select spot_id, min(struct_pack(dist := sqrt((x - px) * (x - px) + (y - py) * (y - py)), line := line_id, seq := seq,
    measure := measure, px := px, py := py)) as near
  from placed {where} group by spot_id)"""


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network nodes in a source tree with up to three at one place, from ``customer``."""
    k = F.col("c_custkey")

    def name(n):
        return F.format_string("n%09d", n)

    tags = [["ug-closure"], ["oh-closure"], ["oh-terminal"], ["access-pt"], ["demand", "ug"], ["demand", "oh"], ["oh-joint"], ["splitter"]]
    pick = F.element_at(F.array(*[F.array(*[F.lit(t) for t in ts]) for ts in tags]), (k % 8 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").select(
        name(k).alias("node_id"), F.format_string("c%09d", F.floor(k / F.lit(3.0))).alias("cand_id"), pick.alias("tags"),
        F.col("c_nationkey").cast("long").alias("demand"),
        F.when(k == 0, "").otherwise(name(F.floor(k / F.lit(4.0)))).alias("src"),
        F.concat(F.lit("in"), k.cast("string")).alias("input_id"), (F.col("c_nationkey") * 6).cast("int").alias("size"),
        F.when(k % 5 == 0, "ug").alias("placement"), F.when(k % 7 != 0, F.col("c_mktsegment")).alias("leg"),
        F.concat(F.lit("p"), (k % 400).cast("string")).alias("parcel_id"),
        F.when((k % 8).isin(2, 3), F.concat_ws(",", name(k + 1), name(k + 9))).alias("access_demand_ids"),
        F.when(k % 3 == 0, F.struct(F.concat(F.lit("g"), (k % 11).cast("string")).alias("group_id"),
                                    F.when(k % 2 == 0, "t1").alias("tube_ids"))).alias("duct_info"),
        F.struct((k % 100).cast("double").alias("x"), F.floor(k / F.lit(100.0)).cast("double").alias("y")).alias("geometry"),
    )


NODES_SQL = """nodes as (
  select 'n' || lpad(cast(c_custkey as varchar), 9, '0') as node_id,
    'c' || lpad(cast(cast(floor(c_custkey / cast(3 as double)) as bigint) as varchar), 9, '0') as cand_id,
    case c_custkey % 8 when 0 then ['ug-closure'] when 1 then ['oh-closure'] when 2 then ['oh-terminal'] when 3 then ['access-pt']
      when 4 then ['demand', 'ug'] when 5 then ['demand', 'oh'] when 6 then ['oh-joint'] else ['splitter'] end as tags,
    cast(c_nationkey as bigint) as demand, c_nationkey * 6 as size,
    case when c_custkey = 0 then '' else 'n' || lpad(cast(cast(floor(c_custkey / cast(4 as double)) as bigint) as varchar), 9, '0') end as src,
    'in' || cast(c_custkey as varchar) as input_id,
    case when c_custkey % 5 = 0 then 'ug' end as placement, case when c_custkey % 7 <> 0 then c_mktsegment end as leg,
    'p' || cast(c_custkey % 400 as varchar) as parcel_id,
    case when c_custkey % 8 in (2, 3) then 'n' || lpad(cast(c_custkey + 1 as varchar), 9, '0') || ',n' || lpad(cast(c_custkey + 9 as varchar), 9, '0') end as access_demand_ids,
    case when c_custkey % 3 = 0 then 'g' || cast(c_custkey % 11 as varchar) end as group_id,
    case when c_custkey % 3 = 0 then case when c_custkey % 2 = 0 then 't1' else '' end end as tube_ids,
    c_custkey as k
  from customer)"""

HUB_SPECS = [("oh-terminal", 0, 60, "8-port"), ("oh-terminal", 60, None, "16-port"), ("ug-closure", 0, None, "96-port"), ("splitter", 30, None, "fdh")]
HUB_SPEC_SQL = """(case when list_contains(tags, 'oh-terminal') and size < 60 then '8-port' when list_contains(tags, 'oh-terminal') then '16-port'
  when list_contains(tags, 'splitter') and size >= 30 then 'fdh' when list_contains(tags, 'ug-closure') then '96-port' else '' end)"""
CABLE_SPECS = [("ug-dist", 0, 30, "48f"), ("ug-dist", 30, None, "96f"), ("ug-feeder", 0, None, "288f"), ("oh-dist", 10, None, "24f")]
DUCT_SPECS = [("ug-duct", 5, 60, "7-way"), ("ug-duct", 60, None, "24-way")]
ROLES = {"SOLUTION_ASSIGN": {"leadin-sol"}, "SOLUTION_DUCT": {"ug-duct"}, "SOLUTION_EDGE": {"ug-dist", "ug-feeder", "oh-dist", "oh-drop"}}


def network_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solution edges between nodes, with the base arcs they run along, from ``orders``."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")

    def name(n):
        return F.format_string("n%09d", n)

    tags = [["leadin-sol"], ["ug-duct"], ["ug-dist"], ["ug-feeder"], ["oh-dist"], ["oh-drop"], ["ug-dist", "ug-duct"]]
    pick = F.element_at(F.array(*[F.array(*[F.lit(t) for t in ts]) for ts in tags]), (o % 7 + 1).cast("int"))

    def arc(n):
        a, b = F.concat(F.lit("b"), (n % 97).cast("string")), F.concat(F.lit("b"), ((n * 3 + 1) % 97).cast("string"))
        return F.struct(F.when(n % 2 == 0, a).otherwise(b).alias("a"), F.when(n % 2 == 0, b).otherwise(a).alias("b"))

    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").select(
        o.alias("edge_id"), name(c).alias("start"), name(F.floor(c / F.lit(4.0))).alias("end"), pick.alias("tags"),
        name(F.floor(c / F.lit(4.0))).alias("src"), (c % 80).cast("int").alias("size"),
        (F.floor(F.col("o_totalprice")) / F.lit(4.0)).alias("length"),
        F.when(o % 3 == 0, "oh").alias("placement"), F.when(o % 4 == 0, "L1").alias("leg"),
        F.array(arc(c), arc(c + 1)).alias("arcs"),
        F.when(o % 5 != 0, F.struct(F.concat(F.lit("g"), (o % 13).cast("string")).alias("group_id"), F.lit("t").alias("tube_ids"))).alias("duct_info"),
        F.array(F.struct(o.cast("double").alias("x"), c.cast("double").alias("y"))).alias("geometry"),
    )


NETWORK_SQL = """net as (
  select o_orderkey as edge_id, 'n' || lpad(cast(o_custkey as varchar), 9, '0') as a_node,
    'n' || lpad(cast(cast(floor(o_custkey / cast(4 as double)) as bigint) as varchar), 9, '0') as b_node,
    case o_orderkey % 7 when 0 then ['leadin-sol'] when 1 then ['ug-duct'] when 2 then ['ug-dist'] when 3 then ['ug-feeder']
      when 4 then ['oh-dist'] when 5 then ['oh-drop'] else ['ug-dist', 'ug-duct'] end as tags,
    o_custkey % 80 as size, floor(o_totalprice) / cast(4 as double) as length,
    case when o_orderkey % 3 = 0 then 'oh' end as placement, case when o_orderkey % 4 = 0 then 'L1' end as leg,
    case when o_orderkey % 5 <> 0 then 'g' || cast(o_orderkey % 13 as varchar) end as group_id,
    case when o_orderkey % 5 <> 0 then 't' end as tube_ids, o_custkey as n
  from orders)"""
ARCS_SQL = """used as (
  select edge_id, tags, size, group_id, 'b' || cast(n % 97 as varchar) as p, 'b' || cast((n * 3 + 1) % 97 as varchar) as r from net
  union all
  select edge_id, tags, size, group_id, 'b' || cast((n + 1) % 97 as varchar), 'b' || cast(((n + 1) * 3 + 1) % 97 as varchar) from net)"""


def base_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base network edges, among them most of the arcs in use, from ``part``."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", "p_size").where(k % 5 != 0).select(
        k.alias("edge_id"), F.concat(F.lit("b"), (k % 97).cast("string")).alias("a"),
        F.concat(F.lit("b"), ((k * 3 + 1) % 97).cast("string")).alias("b"),
        F.when(k % 2 == 0, F.array(F.lit("ug"))).otherwise(F.array(F.lit("oh"))).alias("tags"),
        (F.col("p_size") / F.lit(4.0)).alias("length"),
        F.array(F.struct(k.cast("double").alias("x"), F.lit(0.0).alias("y"))).alias("geometry"))


BASE_SQL = """base as (
  select least(a, b) as a, greatest(a, b) as b, min_by(ug, edge_id) as ug, min_by(length, edge_id) as length from (
    select p_partkey as edge_id, 'b' || cast(p_partkey % 97 as varchar) as a, 'b' || cast((p_partkey * 3 + 1) % 97 as varchar) as b,
      p_partkey % 2 = 0 as ug, p_size / cast(4 as double) as length from part where p_partkey % 5 <> 0)
  group by 1, 2)"""
