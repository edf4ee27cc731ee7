import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chainmark.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [None, "", " ", "a" * 5000, "aaaa bbbb  \n\n x <|endoftext|> y<|endoftext|><|endoftext|>", "\x1c\x1d\x85 　a​", "don't I'LL we'll", "日本語😀👍🏽 ññ", " \t ", "<|endoftext", "é" * 999]


@pytest.fixture(scope="module")
def machines():
    return bpe.Encoder(PATH), bpe.Decoder(PATH), token_counts.Counter(PATH)


def check(machines, texts):
    coder, back, counter = machines
    ids, at = coder.encode(texts)
    for i, (text, decoded) in enumerate(zip(texts, back.decode(ids, at))):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert ids[at[i]:at[i + 1]].tolist() == want
        assert counter.count(text) == len(want)
        assert decoded == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_any_text(machines, texts):
    check(machines, texts)


def test_hard_texts(machines):
    rng = random.Random(1)
    pool = "ab 'stre\n\t\x0b\x1c\x1f\x85  é日😀١²Ⅷ_-"
    check(machines, [t or "" for t in ODD] + ["".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(500)])


def test_memory_of_words_starts_anew(machines, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    monkeypatch.setattr(token_counts, "KNOWN_WORDS", 3)
    for _ in range(3):
        check(machines, ["one two three four five six", "seven one"])


def test_special_strings_as_plain_text():
    ids, at = bpe.Encoder(PATH, special=False).encode(["a<|endoftext|>b"])
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    assert ids.tolist() == plain.encode("a<|endoftext|>b", add_special_tokens=False).ids


def test_broken_sequences_decode_like_the_library():
    vocabulary = bpe.vocabulary(PATH)
    wide = [i for i, p in enumerate(vocabulary.pieces) if len(p) == 1 and p[0] >= 0x80][:40] + [33, 34]
    rng = random.Random(2)
    lists = [rng.choices(wide, k=6) for _ in range(200)]
    import numpy as np
    got = bpe.Decoder(PATH).decode(np.array(sum(lists, [])), np.arange(0, 1201, 6))
    assert got == [LIBRARY.decode(x, skip_special_tokens=False) for x in lists]


def test_operators_on_tables(spark):
    rows = [(i if i % 4 else None, t, "x") for i, t in enumerate(ODD)] + [(1, ODD[3], "y"), (1, ODD[3], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = sorted((repr(d), len(e := LIBRARY.encode(t or "", add_special_tokens=False).ids), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in rows)
    got = bpe.round_trip_digests(df, PATH).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    encoded = bpe.encode(df, PATH)
    back = bpe.decode(encoded, PATH).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(d), t or "") for d, t, _ in rows)
    counts = token_counts.token_counts(df, PATH, limit=3).collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counts) == sorted(
        (repr(d), len((t or "").encode()), n, n > 3) for (d, t, _), n in ((row, len(LIBRARY.encode(row[1] or "", add_special_tokens=False).ids)) for row in rows))
    none = df.limit(0)
    assert bpe.round_trip_digests(none, PATH).collect() == [] and token_counts.token_counts(none, PATH).collect() == []
    gone = spark.createDataFrame([(1, None), (2, [0, 1])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(gone, PATH).collect()} == {1: "", 2: '!"'}
