import hashlib
import math
import random
from fractions import Fraction

import pytest

from chainmark.operators import gaps, linear, merging, noding

PARTS = "id string, pts array<struct<x:double,y:double>>"


def parts(spark, lines):
    return spark.createDataFrame([(k, [(float(x), float(y)) for x, y in pts] if pts is not None else None) for k, pts in lines.items()], PARTS)


def dangling(lines):
    at = {}
    for k, pts in lines.items():
        for far in (False, True):
            at.setdefault(pts[-1 if far else 0], []).append((k, far))
    return {e[0]: p for p, e in at.items() if len(e) == 1}


def greedy(lines, tolerance):
    """All pairs, nearest first."""
    ends = sorted(dangling(lines).items())
    pairs = []
    for i, (e, p) in enumerate(ends):
        for f, q in ends[i + 1:]:
            square = (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
            if e[0] != f[0] and square <= tolerance ** 2:
                tie = "|".join(str(v).lower() if isinstance(v, bool) else v for v in (*e, *f))
                pairs.append((square, hashlib.md5(tie.encode()).hexdigest(), e, f))
    used, taken = set(), set()
    for _, _, e, f in sorted(pairs):
        if e not in used and f not in used:
            used |= {e, f}
            taken.add((e, f))
    return taken


def bridged(spark, lines, tolerance):
    return {((r.id, r.far), (r.other, r.other_far)) for r in gaps.gaps(parts(spark, lines), tolerance).collect()}


def test_bridges_of_ties_forks_rings_and_chains(spark):
    lines = {
        "a": [(0, 0), (10, 0)], "b": [(12, 0), (20, 0)], "c": [(10, 2), (10, 9)],  # b and c are equally far from a
        "f1": [(100, 0), (110, 0)], "f2": [(110, 0), (120, 5)], "f3": [(110, 0), (120, -5)], "g": [(111, 0), (111, 50)],  # three ends at one place
        "ring": [(200, 0), (210, 0), (210, 10), (200, 0)], "near": [(201, -1), (230, -30)], "own": [(300, 0), (310, 5), (301, 0)],
        **{f"s{i}": [(400 + 10 * i - i * i * 0.01, 0), (405 + 10 * i - i * i * 0.01, 0)] for i in range(12)},  # each gap is shorter than the one before
    }
    found = bridged(spark, lines, 5.0)
    assert found == greedy(lines, 5.0)
    names = {k for pair in found for k, _ in pair}
    assert len([p for p in found if ("a", True) in p]) == 1 and not names & {"f1", "f2", "f3", "ring", "own"}
    closed = merging.merge_lines(gaps.close_gaps(parts(spark, {k: v for k, v in lines.items() if k[0] == "s"}), 5.0)).collect()
    assert [r.parts for r in closed] == [12] and len(closed[0].pts) == 24  # the places that two parts now share are there once


@pytest.mark.parametrize("seed,spread", [(1, 60), (2, 12)])
def test_random_ends_against_all_pairs(spark, seed, spread):
    """The second case has hundreds of ends within the tolerance of each other, so smaller radii go first."""
    rng = random.Random(seed)
    lines = {f"l{i}": [(rng.randint(0, spread * 8) / 8, rng.randint(0, spread * 8) / 8), (rng.randint(0, spread * 8) / 8, rng.randint(0, spread * 8) / 8)] for i in range(250)}
    assert bridged(spark, lines, 10.0) == greedy(lines, 10.0)


def test_gaps_keep_keys_apart_and_take_nulls_and_nothing(spark):
    kind = "id string, owner string, pts array<struct<x:double,y:double>>, note string"
    rows = [("a", "u", [(0.0, 0.0), (9.0, 0.0)], "x"), ("b", "v", [(10.0, 0.0), (20.0, 0.0)], None), ("n", "u", None, None), ("e", "u", [], None),
            ("m", "u", [(None, 0.0), (10.0, 0.0)], None), (None, "u", [(10.5, 0.0), (30.0, 0.0)], None)]
    data = spark.createDataFrame(rows, kind)
    assert {(r.id, r.far, r.other, r.other_far) for r in gaps.gaps(data, 2.0, ["owner"]).collect()} == {("a", True, "m", True)}
    closed = gaps.close_gaps(data, 2.0, ["owner"])
    assert closed.columns == data.columns and closed.count() == 6
    assert gaps.gaps(data.limit(0), 2.0).count() == 0 and gaps.close_gaps(data.limit(0), 2.0).count() == 0
    with pytest.raises(ValueError):
        gaps.gaps(data, 0)


UNIT = 10 ** 6


def extended(lines, tolerance):
    """First edges hit, over all pairs in exact fractions: {(line, far): (onto, edge, place)}; places in units."""
    grid = {k: [(round(x * UNIT), round(y * UNIT)) for x, y in pts] for k, pts in lines.items()}
    edges = [(k, i, p, q) for k, pts in grid.items() for i, (p, q) in enumerate(zip(pts, pts[1:])) if p != q]
    own = {(k, False): e for e in reversed(edges) for k in [e[0]]} | {(k, True): e for e in edges for k in [e[0]]}
    out = {}

    def area(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    for end, e in dangling(grid).items():
        mine = own[end]
        tail = mine[2] if end[1] else mine[3]
        d = e[0] - tail[0], e[1] - tail[1]
        length = math.sqrt(float(d[0]) ** 2 + float(d[1]) ** 2)
        r = tuple(a + round(tolerance * UNIT * v / length) for a, v in zip(e, d))
        w = r[0] - e[0], r[1] - e[1]
        hits = []
        for k, i, p, q in edges:
            if (k, i) == mine[:2]:
                continue
            def along(v):
                return Fraction((v[0] - e[0]) * w[0] + (v[1] - e[1]) * w[1], w[0] ** 2 + w[1] ** 2)
            s, t = area(e, r, p), area(e, r, q)
            if s == t == 0:
                lo, hi = sorted((along(p), along(q)))
                share = max(lo, Fraction(0)) if hi >= 0 and lo <= 1 else None
            else:
                a, b = area(p, q, e), area(p, q, r)
                share = Fraction(a, a - b) if s * t <= 0 and a * b <= 0 and a != b else None
            if share is not None:
                hits.append((share, k, i, tuple(a + share * v for a, v in zip(e, w))))
        if hits and min(hits)[0] > 0:
            out[end] = min(hits)[1:]
    return out


def same(found, expected):
    got = {(r.line_id, r.far): r for r in found}
    assert set(got) == set(expected)
    for end, (onto, edge, place) in expected.items():
        r = got[end]
        assert (r.onto, r.onto_seq) == (onto, edge) and abs(r.hit_x * UNIT - place[0]) < 1.1 and abs(r.hit_y * UNIT - place[1]) < 1.1


def edges_of(spark, lines):
    return linear.edge_table(parts(spark, lines).withColumnRenamed("id", "line_id"))


def test_ends_meet_the_first_edge_ahead(spark):
    lines = {
        "wall": [(20, -50), (20, 50)], "behind": [(22, -50), (22, 50)], "a": [(0, 0), (15, 0)], "short": [(0, 10), (14, 10)],  # 5 and 6 ahead
        "par": [(100, 0), (110, 0)], "ahead": [(113, 0), (130, 0)], "beside": [(105, 1), (140, 1)],  # along the ray, and parallel to it
        "joined": [(0, 200), (10, 200)], "touched": [(10, 190), (10, 210)], "beyond": [(12, 190), (12, 210)],  # lies on an edge already
        "v1": [(300, 0), (305, 0)], "v2": [(308, -8), (308, 0)], "v3": [(308, 0), (316, 8)],  # hits the vertex that two lines share
        "hook": [(400, 0), (430, 0), (430, 20), (410, 20), (410, 3)],  # hits its own line
    }
    found = gaps.end_extensions(edges_of(spark, lines), 5.0).collect()
    same(found, extended(lines, 5.0))
    assert {(r.line_id, r.far): r.onto for r in found if r.line_id in ("a", "short", "par", "joined", "v1", "hook")} == {
        ("a", True): "wall", ("par", True): "ahead", ("v1", True): "v2", ("hook", True): "hook"}
    lines = {k: lines[k] for k in ("wall", "a", "hook")}
    table = parts(spark, lines).withColumnRenamed("id", "line_id")
    longer = gaps.extend_ends(table, 5.0)
    rows = {r.line_id: [tuple(p) for p in r.pts] for r in longer.collect()}
    assert rows["a"][-1] == (20, 0) and rows["wall"] == [(20, -50), (20, 0), (20, 50)] and rows["hook"][:3] == [(400, 0), (410, 0), (430, 0)]
    pieces = noding.split_at_crossings(linear.edge_table(longer)).groupBy("line_id").count().collect()
    assert {r.line_id: r["count"] for r in pieces} == {"wall": 2, "a": 1, "hook": 2}


@pytest.mark.parametrize("seed,pairs", [(1, 4096), (2, 8)])
def test_random_ends_against_all_edges(spark, monkeypatch, seed, pairs):
    monkeypatch.setattr(gaps, "CELL_PAIRS", pairs)
    rng = random.Random(seed)
    lines = {}
    for i in range(120):
        x, y = rng.randint(0, 100), rng.randint(0, 100)
        pts = [(x, y)]
        for _ in range(rng.randint(1, 3)):
            pts.append((pts[-1][0] + rng.randint(-9, 9), pts[-1][1] + rng.randint(-9, 9)))
        pts = [p for n, p in enumerate(pts) if not n or p != pts[n - 1]]
        if len(pts) > 1:
            lines[f"l{i}"] = pts
    same(gaps.end_extensions(edges_of(spark, lines), 12.0).collect(), extended(lines, 12.0))


def test_extensions_of_no_lines(spark):
    none = parts(spark, {"a": [(0, 0), (1, 0)]}).withColumnRenamed("id", "line_id").limit(0)
    assert gaps.end_extensions(linear.edge_table(none), 5.0).count() == 0 and gaps.extend_ends(none, 5.0).count() == 0
