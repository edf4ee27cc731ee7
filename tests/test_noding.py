import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from chainmark.operators import linear, noding


def brute(lines):
    """Cuts in exact fractions: {(line, position)} wherever a line meets another or itself, but for plain joints."""
    edges = [(k, i, p, q) for k, pts in lines.items() for i, (p, q) in enumerate(zip(pts, pts[1:])) if p != q]

    def area(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def on(p, q, r):
        return area(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    visits = {}
    for r in {v for *_, p, q in edges for v in (p, q)}:
        for k, i, p, q in edges:
            if on(p, q, r):  # a vertex between two edges is one visit, named by its number
                visits.setdefault(r, set()).add((k, "v", i) if r == p else (k, "v", i + 1) if r == q else (k, "e", i))
    found = {(k, tuple(map(Fraction, r))) for r, v in visits.items() if len(v) > 1 for k, *_ in v}
    for n, (k, _, p, q) in enumerate(edges):
        for m, _, u, v in edges[:n]:
            a, b, c, d = area(p, q, u), area(p, q, v), area(u, v, p), area(u, v, q)
            if a * b < 0 and c * d < 0:
                t = Fraction(c, c - d)
                at = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
                found |= {(k, at), (m, at)}
    return found


def table(spark, lines):
    rows = [(k, i, float(x), float(y)) for k, pts in lines.items() for i, (x, y) in enumerate(pts)]
    return linear.edge_table(spark.createDataFrame(rows, "line_id string, seq int, x double, y double"))


def near(found, expected):
    """The same places, to a unit of the grid; a line may pass a place more than once."""
    places = {(r.line_id, r.x, r.y) for r in found}
    missing = [e for e in expected if not any(e[0] == k and abs(float(e[1][0]) - x) < 1.1e-6 and abs(float(e[1][1]) - y) < 1.1e-6 for k, x, y in places)]
    return len(places) == len(expected) and not missing


FIXED = {
    "a": [(0, 0), (100, 0)], "b": [(50, -20), (50, 20)], "t": [(30, 0), (30, 40)], "over": [(60, 0), (140, 0)], "same": [(0, 0), (100, 0)],
    "bow": [(200, 0), (240, 40), (240, 0), (200, 40)], "loop": [(300, 0), (320, 0), (320, 20), (300, 0)], "spike": [(400, 0), (450, 0), (420, 0)],
    "end": [(140, 0), (140, 60)], "free": [(500, 500), (510, 510), (520, 500)], "near": [(0, -1), (100, -1)],
}


def test_crossings_joints_overlaps_and_loops(spark):
    found = noding.crossings(table(spark, FIXED)).collect()
    assert near(found, brute(FIXED))
    passes = [round(r.measure, 3) for r in found if r.line_id == "bow"]
    assert len(passes) == 2 and passes[0] != passes[1]
    assert not [r for r in found if r.line_id == "free"]


@pytest.mark.parametrize("seed,cell_edges,cell_size", [(1, 64, None), (2, 4, 200.0), (3, 2, 30.0)])
def test_random_lattice_lines_against_all_pairs(spark, seed, cell_edges, cell_size):
    rng = random.Random(seed)
    lines = {f"l{i}": [(rng.randint(-15, 15), rng.randint(-15, 15)) for _ in range(rng.randint(2, 4))] for i in range(40)}
    lines = {k: [p for n, p in enumerate(pts) if not n or p != pts[n - 1]] for k, pts in lines.items()}
    lines = {k: pts for k, pts in lines.items() if len(pts) > 1}
    found = noding.crossings(table(spark, lines), cell_edges=cell_edges, cell_size=cell_size).collect()
    assert near(found, brute(lines))


def test_a_hub_of_many_lines_is_not_compared_in_pairs(spark):
    lines = {f"s{i}": [(0, 0), (1000 + i, 3 * i)] for i in range(200)} | {"x": [(500, -10), (500, 2000)]}
    edges = table(spark, lines)
    grid = noding.on_grid(edges, 6)
    listed, _ = noding._leaves(grid, 2 * 16, 16)
    spoke = (F.col("ax") == F.col("hub_x")) & (F.col("ay") == F.col("hub_y"))
    per_cell = listed.groupBy("level", "cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(spoke, F.lit(False)).cast("long")).alias("s"))
    assert per_cell.agg(F.sum((F.col("n") - F.col("s")) * F.col("n"))).first()[0] < 200 * 200 / 4
    found = {(r.line_id, round(r.x, 3), round(r.y, 3)) for r in noding.crossings(edges, cell_edges=16).collect()}
    assert len([r for r in found if r[0] == "x"]) == 200 and len([r for r in found if r[1:] == (0.0, 0.0)]) == 200


def test_signs_are_exact_where_floating_point_is_not(spark):
    big = 4_000_000_000_000_001
    row = spark.range(1).select(*[F.struct(F.lit(x).cast("long").alias("x"), F.lit(y).cast("long").alias("y")).alias(n) for n, (x, y) in
                                  {"p": (0, 0), "q": (big, big + 2), "on": (2 * big, 2 * big + 4), "left": (2 * big, 2 * big + 5), "right": (2 * big, 2 * big + 3)}.items()])
    got = row.select(*[noding.side(F.col("p"), F.col("q"), F.col(n)).alias(n) for n in ("on", "left", "right")]).first()
    assert (got["on"], got["left"], got["right"]) == (0, 1, -1)


def test_pieces_share_positions_and_keep_lengths(spark):
    edges = table(spark, FIXED)
    pieces = noding.split_at_crossings(edges).collect()
    ends = {(k, c) for k, c in brute(FIXED)}
    assert {r.line_id for r in pieces} == set(FIXED)
    for k in FIXED:
        mine = sorted((r for r in pieces if r.line_id == k), key=lambda r: r.piece)
        total = sum(((q[0] - p[0]) ** 2 + (q[1] - p[1]) ** 2) ** 0.5 for p, q in zip(FIXED[k], FIXED[k][1:]))
        assert abs(sum(r.b - r.a for r in mine) - total) < 1e-6
        for one, two in zip(mine, mine[1:]):
            assert one.pts[-1] == two.pts[0] and (k, (Fraction(one.pts[-1].x), Fraction(one.pts[-1].y))) in ends
    assert len([r for r in pieces if r.line_id == "a"]) == 4  # at 30, 50 and 60


def test_no_lines(spark):
    assert noding.crossings(table(spark, FIXED).limit(0)).collect() == []
