import zlib

import numpy as np

from chainmark.llm import quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r.doc_id: r for r in quality.classified(docs, labels).collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    test = [(rows[r.doc_id].score, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    good, bad = [s for s, q in test if q], [s for s, q in test if not q]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([(s >= 0.3) == q for s, q in test]) > 0.95


def test_scores_do_not_depend_on_labels_of_the_held_out(spark):
    docs = spark.createDataFrame([(i, ("Good words here " if i % 2 else "BAD!! ### ") * (i + 1)) for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(60)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    a, b = ({r.doc_id: r.score for r in quality.classified(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, turned))
    assert a == b and a[59] > 0.8 > 0.2 > a[58]


def test_odd_rows_and_labels(spark):
    rows = [(None, None, 1), (1, "", 1), (2, "plain text of some words", 1), (2, "plain text of some words", 2), (3, "x" * 100_000, 1), (4, " \n\t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    for labels in ([], [(2, 1)], [(2, 1), (2, 0), (3, 0), (None, 1), (4, None), (99, 1)]):
        got = quality.classified(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
        if not labels:
            assert {r.score for r in got} == {0.5}
    none = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    assert quality.classified(docs.limit(0), none).collect() == [] and quality.accepted(docs, none).columns == docs.columns


def test_isotonic():
    knots, levels = quality.isotonic(np.array([3.0, 1.0, 2.0, 4.0]), np.array([0.0, 0.0, 1.0, 1.0]))
    assert (np.diff(levels) >= 0).all() and knots.tolist() == [1.0, 2.5, 4.0]


def test_statistics_do_not_mix_texts():
    texts = [b"Some Words, here.\nand here", b"", b"1 2 3 ###", b"one", b"one one one"]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    whole = quality.statistics(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], quality.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0])


def test_scores_equal_those_of_one_machine(spark):
    """Least squares on stacked rows instead of normal equations, and the max-min form of isotonic regression, on distinct texts."""
    sf = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").dropna()
    docs = given.groupBy("text").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r.score for r in quality.classified(docs, labels).collect()}
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    ids = sorted(texts)
    stats = quality.statistics(np.frombuffer(b"".join(texts[i] for i in ids), np.uint8), np.concatenate(([0], np.cumsum([len(texts[i]) for i in ids]))))
    y = {r.doc_id: float(r.quality) for r in labels.collect() if r.quality is not None}
    crc = np.array([zlib.crc32(str(i).encode()) for i in ids])
    train = np.array([i in y for i in ids]) & (crc % 5 != 0)
    truth, fold = np.array([y.get(i, 0.0) for i in ids])[train], (crc % 5 % 2)[train]
    mean, scale = stats[train].mean(axis=0), np.maximum(stats[train].std(axis=0), 1e-6)
    x = np.column_stack((quality.fourier((stats - mean) / scale), np.ones(len(ids))))

    def ridge(rows, target):
        penalty = np.sqrt(np.append(np.full(quality.FEATURES, quality.RIDGE * len(rows)), 0.0) + 1e-9)
        return np.linalg.lstsq(np.vstack((rows, np.diag(penalty))), np.append(target, np.zeros(len(penalty))), rcond=None)[0]

    seen = x[train]
    halves = [ridge(seen[fold == k], truth[fold == k]) for k in (0, 1)]
    crossed = np.where(fold == 0, seen @ halves[1], seen @ halves[0])
    order = np.argsort(crossed)
    a, b, n = crossed[order], truth[order], len(order)
    sums = np.concatenate(([0.0], np.cumsum(b)))
    means = np.array([[(sums[j + 1] - sums[i]) / (j + 1 - i) if j >= i else np.inf for j in range(n)] for i in range(n)])
    lowest = np.minimum.accumulate(means[:, ::-1], axis=1)[:, ::-1]
    level = np.array([lowest[:i + 1, i].max() for i in range(n)])
    assert (np.diff(level) >= 0).all()
    blocks = np.split(np.arange(n), np.flatnonzero(np.diff(level)) + 1)
    knots, levels = [a[k].mean() for k in blocks], [(b[k].sum() + 0.5) / (len(k) + 1) for k in blocks]
    want = np.interp(x @ ridge(seen, truth), knots, levels)
    assert n > 200 and len(blocks) > 2
    assert max(abs(got[i] - w) for i, w in zip(ids, want)) < 1e-9
