import random

import brute
import numpy as np

from chainmark.llm import minhash


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((repr(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, **options).collect())
    assert got == brute.near_duplicates(rows)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in docs.collect()])


def test_small_cases(spark):
    base = [f"w{i}" for i in range(60)]
    chain = []
    for k in range(6):  # each text differs from the one before by two more words, so the ends are linked by the chain only
        chain.append((30 - k, " ".join(base[2 * k:2 * k + 48])))
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two"), (7, "one\ttwo"),
            (8, "other words here"), (8, "other words here now and then"), (None, "one two"), (9, "Ünder"), (10, "ünder"), *chain]
    check(spark, rows)


def test_no_rows(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string, cls string, bands int")).collect() == []


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 2**63, 900, dtype=np.uint64)
    b = np.concatenate((a[:800], rng.integers(1, 2**63, 100, dtype=np.uint64)))
    low = minhash.superminhash(np.concatenate((a, b)), np.array([0, 900, 1800]), 1000)
    assert abs((low[0] == low[1]).mean() - 0.8) < 0.04


def test_large_groups_in_small_blocks(spark):
    """Near copies at many distances, more than a block holds, so that heads, sides and blocks all matter."""
    rng, rows = random.Random(4), []
    for base in range(3):
        words = [f"b{base}w{i}" for i in range(150)]
        for k in range(60):
            edited = list(words)
            for at in rng.sample(range(150), rng.randint(0, 12)):
                edited[at] = f"e{base}n{k}a{at}"
            rows.append((len(rows), " ".join(edited)))
    check(spark, rows, block=9)
    check(spark, rows)


def test_wide_sets_are_merged_instead():
    values, first = np.array([1, 2, 3, 2, 3, 4, 9], np.int64), np.array([0, 3, 6, 7])
    for cells in (minhash.MATRIX_BITS, 0):
        before, minhash.MATRIX_BITS = minhash.MATRIX_BITS, cells
        try:
            assert minhash.shared_counts(values, first)(0, np.array([1, 2])).tolist() == [2, 0]
        finally:
            minhash.MATRIX_BITS = before
