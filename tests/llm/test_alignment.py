import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chainmark.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PLAIN = Tokenizer.from_file(A)
PLAIN.encode_special_tokens = True
MODEL = sentencepiece.SentencePieceProcessor(model_file=B)
LETTERS = {c: b for c, b in __import__("chainmark.llm.tokens", fromlist=["byte_letters"]).byte_letters().items()}


def tokens(text):
    """(id, bytes) by both tokenizers; nothing where a tokenizer does not give the text back."""
    a = [(i, bytes(LETTERS[c] for c in PLAIN.id_to_token(i))) for i in PLAIN.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in MODEL.encode(text):
        p = MODEL.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if MODEL.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def expected(rows):
    out, per = [], []
    for _, text in rows:
        a, b = tokens(text or "")
        cut, groups, i, j, x, y = [], [], 0, 0, 0, 0
        one, two = [], []
        while i < len(a) or j < len(b):
            if x <= y and i < len(a):
                x += len(a[i][1])
                one.append(a[i][0])
                i += 1
            else:
                y += len(b[j][1])
                two.append(b[j][0])
                j += 1
            if x == y:
                groups.append((one, two))
                one, two = [], []
        links = Counter((p, q) for one, two in groups for p in one for q in two)
        per.append((len(a), len(b), groups, links))
    count = Counter(p for *_, links in per for p in links)
    best = {}
    for (p, _), n in count.items():
        best[p] = max(n, best.get(p, 0))
    for (d, _), (n_a, n_b, groups, links) in zip(rows, per):
        text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in groups)
        out.append((repr(d), n_a, n_b, len(groups), sum(links.values()), sum(k for p, k in links.items() if count[p] == best[p[0]]),
                    sum(k * count[p] for p, k in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out)


def found(df):
    return sorted((repr(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


ODD = [None, "", " ", "  two  spaces ", "a▁b", "x<|endoftext|>y <s> </s>", "日本語 😀👍🏽 ñandú", "\x00\x01 ctl\r\n\ttab", "é é", " 　\x85", "a" * 700, " " * 513 + "x",
       "0123456789" * 30, "don't I'LL", "<0x0A> literal", "한국어 텍스트", "word " * 200]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    pool = ["the", "und", "casa", "ñ", "xylograph", "12.5", "(a)", "—", "  ", "\n\n", "token", "Wörter", "été"]
    return [(i if i != 3 else None, t) for i, t in enumerate(ODD)] + [(100 + i, " ".join(rng.choices(pool, k=rng.randint(1, 40)))) for i in range(60)] + [(101, "the casa"), (101, "the casa")]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5, 0])
def test_alignments_equal_brute_force(spark, rows, frequent):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pairs", F.lit("x")).withColumn("row", F.lit(1)).withColumn("n_a", F.lit(2))
    got = alignment.alignments(df.repartition(5), A, B, frequent)
    assert found(got) == expected(rows)
    assert {c for c, t in got.dtypes if t == "bigint"} == {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"}


def test_query_on_given_table_equals_brute_force(spark, sf_dir):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op12_token_alignment"](spark, sf_dir)) == expected(given)


def test_slices_of_a_wide_group_add_up(monkeypatch):
    text = "a" * 997 + " " * 301 + "b"
    want = alignment.Aligner(A, B).align([text, "x", text])["pairs"]
    monkeypatch.setattr(alignment, "SLICE", 3)
    got = alignment.Aligner(A, B).align([text, "x", text])["pairs"]
    assert all((x == y).all() for x, y in zip(got, want))


def test_coalesced_ranges():
    import numpy as np
    starts, ends = np.array([0, 2, 5, 0, 1, 4, 5]), np.array([2, 5, 7, 1, 4, 5, 7])
    order, group = alignment.coalesced(starts, ends, np.array([0, 0, 0, 1, 1, 1, 1]))
    assert order.tolist() == [0, 3, 4, 1, 5, 2, 6] and group.tolist() == [0, 0, 0, 0, 0, 1, 1]


def test_no_rows_and_only_texts_without_tokens(spark):
    kind = "doc_id long, text string"
    assert alignment.alignments(spark.createDataFrame([], kind), A, B).collect() == []
    assert found(alignment.alignments(spark.createDataFrame([(1, None), (2, "▁")], kind), A, B)) == [("1", *[0] * 6, ""), ("2", *[0] * 6, "")]


def test_the_most_common_counts_have_a_bound(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([2, 3, 3, 4, 9, 1000])], "pair long, n long")
    assert [alignment.frequent_from(counts, k) for k in (6, 5, 3, 2, 1, 0)] == [2, 4, 4, 8, 16, 1024]
    assert alignment.frequent_from(counts.limit(0), 5) == 2
