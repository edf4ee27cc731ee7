import hashlib
import re

import brute
import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from chainmark.llm import minhash, quality, secrets


def test_whole_pipeline_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scores = {r.doc_id: r.score for r in quality.classified(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] >= quality.THRESHOLD]
    sets = brute.near_duplicates(rows, 80, 5)
    stays = {int(d) for d, n, low, kept in sets if kept or n == 0}
    items = [tuple(re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    items = [{w[i:i + 5] for i in range(len(w) - 4)} for w in items]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for d, text in rows:
        w = tuple(re.findall(r"[^\W_]+", text.lower()))
        have = {w[i:i + 5] for i in range(len(w) - 4)}
        if d not in stays or any(100 * len(have & s) >= 80 * len(s) for s in items):
            continue
        spans = sorted((m.start(), m.end()) for r in secrets.BASE_RULES + secrets.MORE_RULES for m in re.finditer(r.pattern, text) if len(m[r.group]) >= r.least)
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, b)
        out += text[at:]
        want[d] = (tok.encode(out, add_special_tokens=False).ids, hashlib.sha256(out.encode()).hexdigest())
    got = {r.doc_id: (list(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want


def test_stages_on_odd_rows(spark, sf_dir):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", "a", 5, 7), (1, text, "en", "a", 5, 7), (2, text + " more", None, None, None, 8), (None, text, "en", "b", 1, 9), (None, None, None, None, None, 1),
            (3, "", "en", "c", 0, 2), (4, "token=abcdefghij end", "en", "c", 3, 2), (5, "unlike\tanything", "de", "d", 4, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    got = minhash.one_of_each(df).collect()
    assert sorted((repr(r.doc_id), r.score) for r in got) == [("1", 7), ("3", 2), ("4", 2), ("5", 3), ("None", 1)]
    model = quality.fit(df, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = [r.doc_id for r in quality.scores(df, model).collect() if r.score >= quality.THRESHOLD]
    everything = [r[0] for r in rows]  # no benchmark item among them
    kept = {"quality_filter": good, "near_duplicates": [r.doc_id for r in got], "decontamination": everything, "secret_masking": everything, "encoding": everything}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, sf_dir)
        assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(map(repr, kept[name]))
        assert name == "encoding" or out.columns == df.columns
        assert stage(spark, df.limit(0), sf_dir).count() == 0
    masked = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.secret_masking(spark, df, sf_dir).collect()}
    assert masked[4] == ("[SECRET] end", 12) and masked[3] == ("", 0)
