import random
from math import gcd

from pyspark.sql import functions as F

from chainmark.operators import covering, linear


def brute(edges):
    """Unit steps of each carrier and how many edges cover each, counted one by one."""
    steps = {}
    for (ax, ay), (bx, by) in edges:
        g = gcd(bx - ax, by - ay)
        ux, uy = (bx - ax) // g, (by - ay) // g
        for i in range(g):
            p, q = sorted([(ax + i * ux, ay + i * uy), (ax + (i + 1) * ux, ay + (i + 1) * uy)])
            steps[p, q] = steps.get((p, q), 0) + 1
    return steps


def stretched(rows):
    return brute([((round(r.x1), round(r.y1)), (round(r.x2), round(r.y2))) for r in rows])


def table(spark, edges):
    rows = [(f"l{i}", n, float(x), float(y)) for i, e in enumerate(edges) for n, (x, y) in enumerate(e)]
    return linear.edge_table(spark.createDataFrame(rows, "line_id string, seq int, x double, y double"))


FIXED = [((0, 0), (10, 0)), ((15, 0), (5, 0)), ((15, 0), (20, 0)), ((30, 0), (40, 0)), ((2, 1), (8, 1)), ((7, -3), (7, 9)), ((7, 2), (7, 4)),
         ((0, 0), (6, 4)), ((9, 6), (3, 2)), ((0, 0), (-6, 4)), ((100, 5), (100, 1)), ((0, 0), (10, 0))]


def test_union_counts_overlaps_once(spark):
    got = {(r.x1, r.y1, r.x2, r.y2) for r in covering.union_lines(table(spark, FIXED)).collect()}
    assert got == {(0, 0, 20, 0), (30, 0, 40, 0), (2, 1, 8, 1), (7, -3, 7, 9), (0, 0, 9, 6), (-6, 4, 0, 0), (100, 1, 100, 5)}


def test_random_edges_against_unit_steps(spark):
    rng, edges = random.Random(4), []
    while len(edges) < 250:
        a, d, k = (rng.randint(0, 12), rng.randint(0, 12)), rng.choice([(1, 0), (0, 1), (1, 1), (2, -1), (-3, 2)]), rng.randint(1, 6)
        edges.append((a, (a[0] + k * d[0], a[1] + k * d[1])))
    steps = brute(edges)
    df = table(spark, edges)
    union = covering.union_lines(df).collect()
    assert stretched(union) == dict.fromkeys(steps, 1)
    assert not {(r.x1, r.y1, (r.y2 - r.y1) / (r.x2 - r.x1) if r.x2 != r.x1 else None) for r in union} & {
        (r.x2, r.y2, (r.y2 - r.y1) / (r.x2 - r.x1) if r.x2 != r.x1 else None) for r in union}  # none could be longer
    counts = {}
    for r in covering.cover_counts(df).collect():
        counts.update(dict.fromkeys(stretched([r]), r.covers))
    assert counts == steps


def test_large_coordinates_and_no_lines(spark):
    far = [((7_000_000, 8_000_000), (7_000_300, 8_000_100)), ((7_000_600, 8_000_200), (7_000_150, 8_000_050))]
    df = table(spark, far)
    assert [tuple(r) for r in covering.union_lines(df).collect()] == [(7_000_000, 8_000_000, 7_000_600, 8_000_200)]
    assert covering.union_lines(df.where(F.lit(False))).collect() == []
