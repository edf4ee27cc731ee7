import random

import brute
import numpy as np
import pytest

from chainmark.llm import recompression, suffix
from chainmark.llm.repeats import Pieces, window_starts


def check_words(spark, rows, width=recompression.WIDTH):
    got = recompression.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), width).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute.without_word_repeats(rows, width)


def check_bytes(spark, rows, width=suffix.WIDTH, seeds=suffix.SEEDS):
    got = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), width, seeds).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute.without_byte_repeats(rows, width)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    vocab = [f"w{i}é" for i in range(500)]
    passage = " ".join(rng.choices(vocab, k=90))
    rows = [(None, None), (1, ""), (2, " \n"), (3, "one two"), (4, passage), (None, passage), (5, "x " + passage + " y"), (5, passage[:300]), (6, passage[40:]),
            (7, "a " * 200), (8, "b " + "a " * 90 + "c"), (9, "a b " * 80), (10, "p q r " * 30 + passage), (11, "p q r " * 29), (12, passage), (12, passage),
            (13, "z" * 5000), (14, "y" * 399), (15, "y" * 400)]
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            a = rng.randrange(0, len(passage) - 50)
            parts += [passage[a:a + rng.randint(10, 500)], " ".join(rng.choices(vocab, k=rng.randint(0, 30)))]
        rows.append((100 + i, rng.choice([" ", "\t", "  "]).join(parts)))
    # Two-letter texts have many partial repeats.
    rows += [(200 + i, " ".join(rng.choices("ab", k=150))) for i in range(10)]
    return rows


def test_odd_rows(spark, odd_rows):
    check_words(spark, odd_rows)
    check_bytes(spark, odd_rows)


def test_short_windows(spark, odd_rows):
    check_words(spark, odd_rows, 7)
    check_bytes(spark, odd_rows, 40, (16, 30))
    check_bytes(spark, odd_rows, 33, (16,))


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, kept string, lo int")
    assert recompression.without_repeats(none).collect() == [] and suffix.without_repeats(none).collect() == []


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check_words(spark, rows)
    check_bytes(spark, rows)


def test_passages_of_over_fifty_words_below_and_at_the_width(spark):
    rng = random.Random(8)
    rows = []
    for size in (suffix.WIDTH - 1, suffix.WIDTH):
        passage = " ".join(f"{rng.randrange(10 ** 5):05d}" for _ in range(55))
        passage = " " + passage.ljust(size - 2, "x") + " "
        rows += [(10 * size + i, f"{i}{passage}{i}") for i in range(3)]
    check_words(spark, rows)
    check_bytes(spark, rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Both are 55 words; bytes go only from the width on.
    assert {(r.doc_id // 10, r.n_removed) for r in recompression.without_repeats(docs).collect()} == {(399, 55), (400, 55)}
    assert {(r.doc_id // 10, r.n_removed, r.n_spans) for r in suffix.without_repeats(docs).collect()} == {(399, 0, 0), (400, 400, 1)}


def test_anchors_of_texts_longer_than_a_packed_place(monkeypatch):
    monkeypatch.setattr(suffix, "_PLACE", 10)
    rng = np.random.default_rng(4)
    first = np.array([0, 30, 5030, 9000])
    pieces = Pieces(suffix.EXACT[rng.integers(0, 256, 9000)])
    starts = window_starts(first, 40)[0]
    names, places = suffix.anchors_of(40, 16)(pieces, first, starts)
    rank = pieces[16] >> np.uint64(10)
    assert places.tolist() == [s + int(np.argmin(rank[s:s + 25])) for s in starts.tolist()]
    assert (names == pieces[16][places]).all()
