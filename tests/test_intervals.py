"""Interval joins by hand and against brute force; how the joins are planned."""

import random

import pytest
from pyspark.sql import functions as F

from chainmark.operators import intervals, scale

POINT = "pid int, line_id string, chainage double"
SECTION = "section_id string, line_id string, start_km double, end_km double"


def brute(points, sections, closed=False):
    out = {}
    for pid, line, c in points:
        hits = [(s, i) for i, l, s, e in sections if l == line and c is not None and s <= c and (c <= e if closed else c < e)]
        out[pid] = min(hits)[1] if hits else None
    return out


def found(df, ident):
    rows = df.collect()
    assert len(rows) == len({r["pid"] for r in rows})
    return {r["pid"]: r[ident] for r in rows}


def test_boundaries(spark):
    points = [(1, "TLX", 1.0), (2, "TLX", 2.0), (3, "TLX", 3.0), (4, "MLX", 1.5), (5, "TLX", None), (6, None, 1.5), (7, "XXX", 1.0)]
    sections = [("a", "TLX", 1.0, 2.0), ("b", "TLX", 2.0, 3.0), ("r", "MLX", 2.0, 1.0)]
    p, s = spark.createDataFrame(points, POINT), spark.createDataFrame(sections, SECTION)
    assert found(intervals.assign_sections(p, s), "section_id") == {1: "a", 2: "b", 3: None, 4: None, 5: None, 6: None, 7: None}
    segs = s.withColumnsRenamed({"section_id": "chainage_id", "start_km": "chainage_start_km", "end_km": "chainage_end_km"})
    assert found(intervals.find_segments(p, segs), "chainage_id") == {1: "a", 2: "a", 3: "b", 4: None, 5: None, 6: None, 7: None}
    assert [r["section_id"] for r in intervals.reversed_sections(s).collect()] == ["r"]


@pytest.mark.parametrize("options,closed", [
    ({}, False), ({}, True), ({"limit_bytes": 0, "hot_rows": 10}, True), ({"width": 0.05}, False), ({"width": 1000.0}, False)])
def test_against_brute_force(spark, options, closed):
    rng = random.Random(3)
    sections = []
    for i in range(150):
        start = round(rng.uniform(-5, 40), rng.choice([0, 1, 3]))
        sections.append((f"s{i:03d}", rng.choice("AB"), start, start + round(rng.choice([0, 0.01, 0.5, 3, 15]) * rng.random(), 2)))
    # a crowd of tiny sections in one place, and nested ones that start together
    sections += [(f"t{i:03d}", "A", 7 + i / 1000, 7 + i / 1000 + 0.002) for i in range(200)]
    sections += [(f"u{i:03d}", "B", 9.0, 9.0 + (i + 1) / 100) for i in range(100)]
    points = [(i, rng.choice("AB"), rng.choice([7.05, 9.5, round(rng.uniform(-6, 60), 3), float(rng.randint(-5, 50))])) for i in range(1500)]
    p, s = spark.createDataFrame(points, POINT), spark.createDataFrame(sections, SECTION)
    rows = intervals.interval_join(p, s, closed=closed, **options)
    assert found(rows, "section_id") == brute(points, sections, closed)


def test_no_sections(spark):
    p = spark.createDataFrame([(1, "A", 1.0)], POINT)
    assert found(intervals.assign_sections(p, spark.createDataFrame([], SECTION)), "section_id") == {1: None}


def test_empty_line_is_no_error(spark):
    p = spark.createDataFrame([(1, "A", 1.0)], POINT)
    s = spark.createDataFrame([("x", "B", 0.0, 2.0)], SECTION)
    assert found(intervals.assign_sections(p, s), "section_id") == {1: None}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_plans(spark, sf_dir):
    from chainmark.plans import condition_queries as C
    text = plan(C.assigned(spark, sf_dir))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text and "Python" not in text
    # The join on (line, bin) is above everything else: the measurements are not exchanged before it.
    assert text.index("BroadcastHashJoin [line_id") < text.index("Exchange")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = plan(C.j3_interval_join_shuffled(spark, sf_dir))
        assert "BroadcastNestedLoopJoin" not in shuffled
        keys = [line for line in shuffled.splitlines() if "SortMergeJoin" in line and "_salt" in line]
        assert keys and all("_bin" in line for line in keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_one_fact_shuffle_for_statistics(spark, sf_dir):
    """All measures of a section are aggregated behind one exchange of the measurements."""
    from chainmark.operators import stats
    from chainmark.plans import condition_queries as C
    text = plan(stats.rp_stats(C.assigned(spark, sf_dir)))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(section_id" in line]
    assert len(exchanges) == 1 and "Python" not in text


def test_salting_keeps_rows(spark):
    fact = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"), F.col("id").alias("v"))
    dim = spark.range(60).where("id <> 7").select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("left", "inner"):
        ours = scale.salted_join(fact, dim, ["k"], how=how, hot_rows=100)
        plain = fact.join(dim, "k", how).select(*ours.columns)
        assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_numbering(spark):
    df = spark.range(3000).select(((F.col("id") * 7919) % 3001).alias("key"))
    rows = scale.numbered(df.repartition(7), ["key"], "n").orderBy("key").collect()
    assert [r["n"] for r in rows] == list(range(1, 3001))


def test_running_sum(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, "a").otherwise("b").alias("k"), F.col("id").alias("seq"), F.lit(1.0).alias("v"))
    rows = scale.running_sum(df, ["k"], "seq", "v", "s", block=64).collect()
    assert all(r["s"] == (r["seq"] if r["k"] == "a" else r["seq"] - 700) for r in rows)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_null_keys_go_around_a_salted_join(spark, how):
    fact = spark.range(300).selectExpr("id", "case when id % 3 > 0 then id % 2 end as k")
    dim = spark.createDataFrame([(0, "a"), (None, "b")], "k long, v string")
    ours = scale.lookup_join(fact, dim, ["k"], how=how, limit_bytes=0, hot_rows=10)
    plain = fact.join(dim, "k", how).select(*ours.columns)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))
