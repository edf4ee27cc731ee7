import hashlib

import public_tokenizers
from compare import compare
from hypothesis import given
from hypothesis import strategies as st

from chainmark.llm import chat, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = st.text("\\#:</turn>\n ae", max_size=40)


@given(st.lists(st.tuples(HARD, HARD), max_size=4))
def test_escapes_are_reversible(turns):
    assert chat.parsed("".join("".join(chat.formatted(*t)) for t in turns)) == turns
    for role, text in turns:
        assert chat.formatted(role, text)[1].replace("\\</turn>", "").count("</turn>") == 0


def test_query_gives_the_rows_of_its_sql(spark):
    name = "op2_chat_prefix_trees"
    assert compare(spark, "/root/testdata/sf0.01", queries.QUERIES[name], queries.SQL[name]) == ""


def test_trees_and_odd_rows(spark):
    say, hear = "hello </turn> there", "### assistant:\n<|endoftext|> \\"
    rows = [(1, 0, "user", say), (1, 1, "assistant", hear), (1, 2, "user", "one"), (2, 0, "user", say), (2, 1, "assistant", hear), (2, 2, "user", "two"),
            (3, 0, "user", say), (4, 5, "user", say), (4, 9, "assistant", hear), (5, 0, None, None), (6, None, "assistant", "late"), (6, 0, "assistant", "early"),
            (None, 0, "user", say), (7, 0, "a:b", ""), (8, 0, "user", "x"), (8, 0, "user", "x"), (9, 0, "assistant", "é😀" * 3000),
            *((10, t, "user", f"turn {t}") for t in range(300)), *((11, t, "user", f"turn {t}" if t != 150 else "fork") for t in range(300)), *((12, t, "user", f"turn {t}") for t in range(200)),
            *((13, t, "user", f"turn {t}" if t not in (150, 250) else "fork") for t in range(300)), (14, 0, "user", "turn 0"), (14, 1, "user", "elsewhere")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, start int")
    trees, leaves = chat.prefix_trees(df, PATH)
    nodes = sorted(trees.collect(), key=lambda r: r.start)
    ends = [0]
    for r in nodes:  # each token once, depth-first, without gaps
        assert r.start == ends[-1] and r.size == len(r.ids)
        ends.append(r.start + r.size)
        assert r.position == sum(b - a for a, b in [tuple(x) for x in r.attend])
    for r in nodes:
        above = [x for a, b in [tuple(x) for x in r.attend] for x in nodes if a <= x.start < b]
        assert [x.depth for x in above] == list(range(1, r.depth)) and all(x.tree == r.tree for x in above)
        assert r.position == sum(x.size for x in above)
    assert max(len(r.attend) for r in nodes) == 4
    assert len(nodes) == 4 + 1 + 2 + 1 + 2 + 1 + 300 + 150 + 50 + 1
    got = {r.conv_id: r for r in chat.read_back(trees, leaves, PATH).collect()}
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len("".join(chat.formatted(r, t))) for r, t in turns)


def test_no_rows(spark):
    trees, leaves = chat.prefix_trees(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), PATH)
    assert trees.collect() == [] and chat.read_back(trees, leaves, PATH).collect() == []
