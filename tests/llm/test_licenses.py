import random
import re
import string

import pytest
from compare import compare
from pyspark.sql import functions as F

from chainmark.llm import licenses, queries


def expected(rows, base=licenses.BASE, more=licenses.MORE):
    out = []
    for d, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
        at = [(i, t.label) for t in base for i in range(len(w)) if w[i:i + len(t.words)] == t.words]
        labels, score = {x for _, x in at}, float(bool(at))
        for t in more:
            have = max((len(set(w[k:k + 2 * t.width]) & set(t.words)) for k in range(0, len(w), t.width)), default=0)
            if 100 * have >= t.percent * len(set(t.words)):
                labels.add(t.label)
                score = max(score, have / len(set(t.words)))
        places = [i for i, _ in at]
        out.append((repr(d), len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})), ",".join(sorted(labels)), score))
    return sorted(out, key=repr)


def found(df):
    return sorted(((repr(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in df.collect()), key=repr)


def test_query_gives_the_rows_of_its_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", queries.QUERIES["op13_license_scan"], queries.SQL["op13_license_scan"]) == ""


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.QUERIES["op13_license_scan"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    index = licenses.Index.of(licenses.BASE + licenses.MORE, {})
    for step in (licenses.listed_blocks(spark.read.parquet(f"{sf_dir}/documents.parquet"), index),):
        assert not re.search("Python|Arrow|Pandas", step._jdf.queryExecution().toString())


ODD = [None, "", " .,;", "CC BY", "cc-by cc_by, CC\nBY", "ccby cc byte", "cc by cc by cc by", "x " * 3 + "all rights reserved", "All RIGHTS, (reserved)", "all rights all rights reserved",
       "GNU general pubKic license", "general public licenses general public license\x00", "all rights　reserved", "é all rights reserved é", "by cc", "İ cc by ß"]


@pytest.mark.parametrize("percent", [80, 60])
def test_texts_and_blocks_against_brute_force(spark, percent):
    rng = random.Random(percent)
    more = tuple(licenses.Template(t.label, t.text, min(t.percent, percent) if t.percent < 100 else 100) for t in licenses.MORE)
    vocabulary = sorted({w for t in more for w in t.words})
    rows = [(i if i != 4 else None, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (3, ODD[3])]
    for i in range(150):
        t = rng.choice(licenses.BASE + more)
        kept = [w for w in t.words if rng.random() < rng.choice([1.0, 0.85, 0.7])]
        noise = [rng.choice(vocabulary) if rng.random() < 0.3 else f"n{rng.randint(0, 999)}" for _ in range(rng.randint(0, 150))]
        cut = rng.randint(0, len(noise))
        rows.append((1000 + i, rng.choice([" ", ", ", "\n"]).join(noise[:cut] + kept + noise[cut:])))
    rows.append((9999, "the license of " * 20_000 + licenses.MORE[-2].text + " all rights reserved" * 500))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("blocks", F.lit("x")).withColumn("label", F.lit("y"))
    assert found(licenses.license_report(df.repartition(4), licenses.BASE, more)) == expected(rows, licenses.BASE, more)


def test_no_rows_and_other_templates(spark):
    kind = "doc_id long, text string"
    assert licenses.license_report(spark.createDataFrame([], kind)).collect() == []
    mine = (licenses.Template("mine", "one two three four five six seven eight nine ten", 50),)
    rows = [(1, "ten nine eight seven six"), (2, "ten nine eight seven"), (3, "five four " + "x " * 40 + "one two three"), (4, "ONE two\tthree; four five " * 3)]
    assert found(licenses.license_report(spark.createDataFrame(rows, kind), (), mine)) == expected(rows, (), mine)


def test_prefixes_are_the_rarest_words():
    index = licenses.Index.of((licenses.Template("a", "common rare middle", 60),), {"common": 100, "middle": 10, "rare": 1})
    assert index.order == ["rare", "middle", "common"] and [(r[1], r[6]) for r in index.rows] == [("rare", 0), ("middle", 1)]
