import hashlib
import random
import re
import zlib

import pytest
from compare import compare
from pyspark.sql import functions as F

from chainmark.llm import prefix_trie, queries


def expected(rows):
    """All nodes, from a dictionary of prefixes."""
    turns = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        turns.setdefault(c, []).append((role or "", text or ""))
    whole = {}
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] = saved.get(p[:d], 0) + (len(m) - 1) * words
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
    return sorted((min(m), len(p), -(1 << 60) if not p else min(members[p[:-1]]), len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == p).encode()).hexdigest()) for p, m in members.items())


def found(df):
    assert dict(df.dtypes) == {**{c: "bigint" for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}, "ends_sha256": "string"}
    return sorted((r.conv_id, r.depth, -(1 << 60) if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_query_gives_the_rows_of_its_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", queries.QUERIES["op11_prefix_trie"], queries.SQL["op11_prefix_trie"]) == ""


@pytest.mark.parametrize("seed,part_bytes,fanout", [(1, 1 << 20, 256), (2, 1 << 20, 3), (3, 600, 3)])
def test_random_conversations_over_many_partitions(spark, monkeypatch, seed, part_bytes, fanout):
    monkeypatch.setattr(prefix_trie, "FANOUT", fanout)
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 160), *range(-45, -20), 1000, 1003, 2039]:
        if rng.random() < 0.1:
            continue
        turns = [("user", "same start here")] * 5 if rng.random() < 0.35 else [
            (rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d e f"])) for _ in range(rng.randint(0 if c % 7 else 1, 6))]
        rows += [(c, i if i or rng.random() < 0.5 else None, r, t) for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    assert found(prefix_trie.prefix_trie(table(spark, rows), part_bytes)) == expected(rows)


def test_long_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FANOUT", 2)
    long = [(20, i, "user", f"word {i % 7} again") for i in range(250)]
    copies = [(c, i, "user", f"t{i}") for c in range(100, 400) for i in range(4)]
    rows = long + copies + [(21, i, r, t) for _, i, r, t in long[:180]]
    assert found(prefix_trie.prefix_trie(table(spark, rows), 4_000)) == expected(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "gone"), (5, None, None, None), (5, 1, "user", "x\x0by　z"), (6, 0, "", ""), (6, 0, "", ""), (7, 1, "user", "z" * 100_000), (0, 0, None, None)]
    df = table(spark, rows).withColumn("depth", F.lit("x")).withColumn("entry", F.lit(1)).withColumn("path", F.lit(2))
    assert found(prefix_trie.prefix_trie(df)) == expected(rows)
    assert prefix_trie.prefix_trie(table(spark, [])).collect() == []
    # Equal turn numbers: the order of the rows does not matter.
    tied = [(3, 1, "user", "one"), (3, 1, "user", "two"), (3, 1, "assistant", "one"), (23, 1, "user", "two"), (23, 1, "assistant", "one"), (23, 1, "user", "one")]
    assert found(prefix_trie.prefix_trie(table(spark, tied))) == found(prefix_trie.prefix_trie(table(spark, tied[::-1])))


def test_a_name_tells_role_and_text_apart(spark):
    entries = [r.entry for r in prefix_trie.named_turns(table(spark, [(1, 0, "a", "b c"), (1, 1, "ab", " c"), (1, 2, "a", "b c")])).orderBy("turn").collect()]
    assert entries[0] == entries[2] != entries[1]
    assert [int.from_bytes(e[16:], "big") for e in entries] == [2, 1, 2]
