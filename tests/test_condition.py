"""Thresholds, flags and status by hand, and statistics against numpy."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainmark.constants import STATUS_METRICS, STATUS_PARAMS, THRESHOLDS, WEAR_MEASURES
from chainmark.functions.condition import limit_of, status_level, status_score
from chainmark.operators import stats


def expected_limit(clas, param, hand, track):
    value = THRESHOLDS.get(clas, {}).get(param)
    if not isinstance(value, dict):
        return value
    if hand is None:
        return value["lo"]
    return {("RH", "w"): value["lo"], ("RH", "e"): value["hi"], ("LH", "e"): value["lo"], ("LH", "w"): value["hi"]}.get((hand, track))


def test_limits(spark):
    cases = list(itertools.product(["tangent", "mild_curve", "sharp_curve", "spiral"], ["RH", "LH", None, "??"]))
    df = spark.createDataFrame(cases, "class string, hand string")
    for track, param in itertools.product("we", STATUS_PARAMS):
        rows = df.select("class", "hand", limit_of(F.col("class"), param, F.col("hand"), track).alias("v")).collect()
        assert {(r["class"], r["hand"]): r["v"] for r in rows} == {(c, h): expected_limit(c, param, h, track) for c, h in cases}


@pytest.mark.parametrize("offset,flag", [(0.5, "exceeds"), (0.0, ""), (-0.5, ""), (1e-9, "exceeds")])
def test_flag_is_strict(spark, offset, flag):
    names = [f"{m}_{t}_{p}" for m in STATUS_METRICS for t in "ew" for p in STATUS_PARAMS]
    rows = []
    for clas, hand in itertools.product(["Tangent", "Mild Curve", "Sharp Curve"], ["RH", "LH", None]):
        rows.append((clas, hand, *[float(expected_limit(clas.lower().replace(" ", "_"), n.split("_", 2)[2], hand, n.split("_")[1])) + offset for n in names]))
    df = spark.createDataFrame(rows, "classification string, hand string, " + ", ".join(f"{n} double" for n in names))
    found = stats.with_status(df).collect()
    assert len(found) == 9
    for row in found:
        assert {row[f"status_{n}"] for n in names} == {flag}
        assert row["status_string"] == ("RRR-RRR" if flag else "GGG-GGG")
        assert row["status_score"] == (18 if flag else 0)


def test_colours_and_order(spark):
    names = [f"{m}_{t}_{p}" for m in STATUS_METRICS for t in "ew" for p in STATUS_PARAMS]
    values = dict.fromkeys(names, 0.0)
    values.update(p90_w_vert_wear=99.0, p90_e_side_wear=99.0, p75_e_side_wear=99.0, p75_w_rel_head_loss=99.0)
    schema = "classification string, hand string, " + ", ".join(f"{n} double" for n in names)
    row = stats.with_status(spark.createDataFrame([("Tangent", None, *values.values())], schema)).first()
    assert (row["status_string"], row["status_level"], row["status_score"]) == ("GAG-GGR", "R", 4)
    unknown = stats.with_status(spark.createDataFrame([("Spiral", None, *values.values())], schema)).first()
    assert unknown["status_string"] is None and unknown["status_level"] is None and unknown["status_score"] is None


def test_levels(spark):
    df = spark.createDataFrame([("GGG-GGG",), ("GAG-GGG",), ("AAG-GGR",)], "s string")
    rows = df.select("s", status_level(F.col("s")), status_score(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [("GGG-GGG", "G", 0), ("GAG-GGG", "A", 1), ("AAG-GGR", "R", 5)]


def measurements(spark, groups, seed=7, missing=0.0):
    rng = random.Random(seed)
    rows = []
    for key, n in groups.items():
        for _ in range(n):
            rows.append((key, *[None if rng.random() < missing else rng.choice([rng.uniform(0, 50), float(rng.randint(0, 9))]) for _ in WEAR_MEASURES]))
    return rows, spark.createDataFrame(rows, "section_id string, " + ", ".join(f"{c} double" for c in WEAR_MEASURES)).repartition(5)


@pytest.mark.parametrize("options,missing", [
    ({}, "propagate"), ({}, "skip"), ({"hot_rows": 150}, "propagate"), ({"hot_rows": 0}, "skip")])
def test_statistics_match_numpy(spark, options, missing):
    groups = {"a": 1, "b": 2, "c": 37, "hot": 900, "hot2": 400, None: 50}
    rows, df = measurements(spark, groups, missing=0.002)
    found = {r["section_id"]: r for r in stats.rp_stats(df, missing=missing, **options).collect()}
    assert set(found) == {"a", "b", "c", "hot", "hot2"}
    for key, row in found.items():
        own = [r for r in rows if r[0] == key]
        assert row["num_points"] == len(own)
        for i, name in enumerate(WEAR_MEASURES.values(), start=1):
            values = [r[i] for r in own if r[i] is not None]
            if values:
                expect = dict(min=min(values), max=max(values), avg=np.mean(values), std=np.std(values))
                for k, v in expect.items():
                    assert row[f"{k}_{name}"] == pytest.approx(v, abs=1e-9)
            if missing == "propagate" and len(values) < len(own):
                assert row[f"p75_{name}"] is None
            elif values:
                for p in (50, 75, 90):
                    assert row[f"p{p}_{name}"] == pytest.approx(np.percentile(values, p), abs=1e-9)


@pytest.mark.parametrize("values", [[1e15, 3e15], [1.0, 1e14, 2e14], [-1e20, 5.0], [2e-13, 4e-13], [0.0, 3e-9], [1.0, float("inf")]])
def test_mean_takes_values_of_any_size(spark, values):
    df = spark.createDataFrame([("a", *[v] * 6) for v in values], "section_id string, " + ", ".join(f"{c} double" for c in WEAR_MEASURES))
    assert stats.rp_stats(df).first()["avg_e_vert_wear"] == pytest.approx(np.mean(values), rel=1e-12, abs=0)


def test_one_value_fills_a_hot_group(spark):
    """A third of all rows with the same value cannot be split by value; they are counted before the shuffle."""
    rows = [("hot", *[5.0] * 6)] * 3000 + [("hot", *[float(i)] * 6) for i in range(100)] + [("b", *[1.0] * 6)] * 5
    df = spark.createDataFrame(rows, "section_id string, " + ", ".join(f"{c} double" for c in WEAR_MEASURES))
    row = stats.rp_stats(df, hot_rows=100).where("section_id = 'hot'").first()
    assert row["p50_e_vert_wear"] == 5.0 and row["p90_w_side_wear"] == 5.0 and row["num_points"] == 3100


def test_approximate(spark):
    _, df = measurements(spark, {"a": 200})
    assert stats.rp_stats(df, approx=True).first()["p50_e_vert_wear"] is not None


def test_missing_group_has_no_flag(spark):
    rows = [("a", None, *[20.0] * 5), ("a", *[20.0] * 6)]
    df = spark.createDataFrame(rows, "section_id string, " + ", ".join(f"{c} double" for c in WEAR_MEASURES))
    sections = spark.createDataFrame([("a", 1, "Tangent", None)], "section_id string, seq int, classification string, hand string")
    row = stats.with_status(stats.with_section(stats.rp_stats(df), sections)).first()
    assert row["status_avg_e_vert_wear"] == "exceeds" and row["status_p90_e_vert_wear"] == "" and row["status_p90_w_vert_wear"] == "exceeds"


def test_first_row_of_an_id_is_used(spark):
    sections = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early")], "section_id string, seq int, name string")
    assert stats.first_section_rows(sections).first()["name"] == "early"
