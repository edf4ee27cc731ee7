import random

import pytest
from pyspark.sql import functions as F

from chainmark.operators import merging


def brute(parts):
    """Merged lines {smallest part: (ids with direction, vertices)} by walking."""
    at = {}
    for i, pts in parts.items():
        at.setdefault(pts[0], []).append((i, False))
        at.setdefault(pts[-1], []).append((i, True))
    link = {}
    for ends in at.values():
        if len(ends) == 2:
            link[ends[0]], link[ends[1]] = ends[1], ends[0]

    def walk(i, back):
        out = [(i, back)]
        while (nxt := link.get((out[-1][0], not out[-1][1]))) and nxt != out[0]:
            out.append(nxt)
        return out, nxt is not None

    out, seen = {}, set()
    for i in sorted(parts):
        if i in seen:
            continue
        forward, ring = walk(i, False)
        before = [] if ring else [(j, not b) for j, b in walk(i, True)[0][:0:-1]]
        chain = before + forward
        seen |= {j for j, _ in chain}
        pts = []
        for j, b in chain:
            piece = parts[j][::-1] if b else parts[j]
            pts += piece[1:] if pts else piece
        out[i] = (chain, pts)
    return out


def frame(spark, parts):
    return spark.createDataFrame([(i, [(float(x), float(y)) for x, y in pts]) for i, pts in parts.items()], "id long, pts array<struct<x:double,y:double>>")


def check(spark, parts):
    want = brute(parts)
    got = {r.chain: r for r in merging.merge_lines(frame(spark, parts)).collect()}
    assert {k: (r.parts, [tuple(p) for p in r.pts]) for k, r in got.items()} == {k: (len(c), [(float(x), float(y)) for x, y in pts]) for k, (c, pts) in want.items()}
    order = {}
    for r in merging.merged_order(frame(spark, parts)).collect():
        order.setdefault(r.chain, {})[r.place] = (r.id, r.back)
    assert {k: [v[p] for p in range(len(v))] for k, v in order.items()} == {k: c for k, (c, _) in want.items()}


FIXED = {
    5: [(0, 0), (1, 0)], 3: [(2, 0), (1, 5), (1, 0)], 9: [(3, 0), (2, 0)],  # a chain whose smallest part is turned
    10: [(10, 0), (11, 0)], 11: [(11, 0), (12, 0)], 12: [(11, 0), (11, 3)], 13: [(12, 0), (13, 0)],  # a fork at (11, 0)
    22: [(20, 0), (21, 0)], 21: [(21, 0), (21, 1)], 20: [(20, 0), (21, 1)],  # a ring, cut where part 20 starts
    30: [(30, 0), (31, 1), (32, 0), (30, 0)],  # closed by itself
    40: [(40, 0), (41, 0), (40, 0)], 41: [(40, 0), (45, 5)],  # a loop with a tail: three ends meet
    50: [(50, 0), (51, 0)], 51: [(51, 0), (50, 0)],  # a ring of two
    60: [(60, 0)], 70: [(70.5, -1), (71, 2)],
}


def test_chains_forks_and_rings(spark):
    check(spark, FIXED)


@pytest.mark.parametrize("seed", [1, 2])
def test_fourteen_lines_of_a_random_network(spark, seed):
    """Lines cut into parts of random length, turned at random, with branches and rings, as brute force merges them."""
    rng, parts, n = random.Random(seed), {}, 0
    ids = rng.sample(range(1000), 1000)
    for line in range(14):
        pts = [(line * 100 + i, rng.randint(0, 50)) for i in range(rng.randint(4, 60))]
        if line % 5 == 0:
            pts.append(pts[0])
        if line % 4 == 1:
            pts[0] = ((line - 1) * 100 + 2, parts[ids[0]][0][1]) if n else pts[0]
        at = 0
        while at < len(pts) - 1:
            to = min(len(pts) - 1, at + rng.randint(1, 6))
            piece = pts[at:to + 1]
            parts[ids[n]] = piece[::-1] if rng.random() < 0.5 else piece
            n, at = n + 1, to
    check(spark, parts)


def test_long_chains_take_logarithmic_rounds(spark, monkeypatch):
    calls = []
    real = merging.checkpointed
    monkeypatch.setattr(merging, "checkpointed", lambda df: calls.append(1) or real(df))
    ids = random.Random(3).sample(range(10_000), 10_000)
    parts = spark.createDataFrame([(i, [(float(k), 0.0), (float(k + 1), 0.0)][:: 1 if i % 2 else -1]) for k, i in enumerate(ids)], "id long, pts array<struct<x:double,y:double>>")
    got = merging.merge_lines(parts).collect()
    assert len(got) == 1 and got[0].parts == 10_000 and len(got[0].pts) == 10_001
    xs = [p.x for p in got[0].pts]
    assert xs == sorted(xs) or xs == sorted(xs, reverse=True)
    assert len(calls) < 25


def test_keys_part_lines_and_empty_tables(spark):
    df = frame(spark, {1: [(0, 0), (1, 0)], 2: [(1, 0), (2, 0)], 3: [(2, 0), (3, 0)]}).withColumn("line_id", F.when(F.col("id") < 3, "a").otherwise("b"))
    assert sorted((r.line_id, r.chain, r.parts) for r in merging.merge_lines(df, ["line_id"]).collect()) == [("a", 1, 2), ("b", 3, 1)]
    assert merging.merge_lines(df.limit(0)).collect() == []
    assert merging.merge_lines(df.withColumn("pts", F.array().cast(df.schema["pts"].dataType))).collect() == []
