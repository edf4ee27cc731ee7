"""The numbered queries, each over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chainmark.llm import alignment, bpe, caps, chat, decontaminate, licenses, minhash, prefix_trie, quality, recompression, secrets, suffix, token_counts
from chainmark.plans.registry import Build

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(build: Build) -> Build:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation that holds the template's own control strings.
HARD_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@query
def op2_chat_prefix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame(HARD_TURNS, "conv_id long, turn long, role string, text string")
    trees, leaves = chat.prefix_trees(given.unionByName(hard), path)
    return chat.read_back(trees, leaves, path)


@query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignments(table(spark, sf_dir, "documents"), *paths)


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '')"

SQL["op1_benchmark_decontamination"] = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS k, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS s
  FROM i, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS r(p) WHERE len(w) > 0),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
widths AS (SELECT DISTINCT k FROM items),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
runs AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM d, widths, unnest(range(1, len(w) - k + 2)) AS r(p) WHERE len(w) >= k),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM runs JOIN items USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n AS n_item, n_shared / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared * 100 >= n * 80
"""


def _found(rule: secrets.Rule, order: int) -> str:
    """SQL for the spans of one rule: positions from the lengths of matches and of the text between them."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {order} AS ord, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'s': a[i], 'e': a[i] + length(m[i]), 'n': length(g[i])}})) AS x
  FROM (SELECT doc_id, m, g, list_transform(range(1, len(m) + 1), lambda i:
            coalesce(list_sum(list_transform(p[1:i], lambda y: length(y))), 0)::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0)::BIGINT) AS a
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
                     string_split_regex(t, '{pattern}') AS p
              FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WHERE regexp_matches(t, '{pattern}')))"""


_RULES = secrets.BASE_RULES + secrets.MORE_RULES
SQL["op10_secret_scan"] = f"""
WITH f AS ({" UNION ALL ".join(f"SELECT doc_id, ord, x.s AS s, x.e AS e FROM ({_found(r, n)}) WHERE x.n >= {r.least}" for n, r in enumerate(_RULES))}),
k AS (SELECT *, {repr([r.kind for r in _RULES])}[ord + 1] || ':' || s || ':' || e AS span FROM f)
SELECT d.doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, ord, e) FILTER (ord < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY s, ord, e), '') AS spans
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id
"""

SQL["op2_chat_prefix_trees"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS body,
  replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS head FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(head) + 2 + length(body) + 8)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

#: Classes of a relation ``links(u, v)`` in both directions: every row that each row reaches.
_REACH = "reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u), low AS (SELECT u, min(v) AS low FROM reach GROUP BY u)"

SQL["op4_embedding_near_dedup"] = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
fine AS (SELECT * FROM vectors WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
sized AS (SELECT *, sqrt(list_dot_product(e, e)) AS size FROM fine),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM sized a JOIN sized b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
{_REACH},
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM vectors LEFT JOIN degree d ON d.u = vec_id LEFT JOIN low w ON w.u = vec_id
"""

SQL["op5_recompression_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM w, unnest(range(1, len(w) - 33)) AS r(i) WHERE len(w) >= 35),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN twice USING (h), range(35) AS s(k)),
kept AS (SELECT doc_id, string_agg(w[p], ' ' ORDER BY p) AS kept, count(*) AS n
  FROM (SELECT doc_id, w, p FROM w, unnest(range(1, len(w) + 1)) AS r(p)) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

SQL["op6_minhash_near_dedup"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM w, unnest(range(1, greatest(len(w) - 1, 2))) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * k >= 85 * (x.n + y.n - k)),
{_REACH}
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id, w.doc_id <= coalesce(low, w.doc_id) AS kept
FROM w LEFT JOIN sizes z ON z.doc_id = w.doc_id LEFT JOIN low o ON o.u = w.doc_id
"""

SQL["op8_suffix_dedup"] = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT doc_id, k, substr(h, 1000 * k + 1, 1798) AS part FROM t, unnest(range(0, (length(h) + 999) // 1000)) AS r(k)),
b AS (SELECT doc_id, 500 * k + j AS i, substr(part, 2 * j - 1, 2) AS x, CASE WHEN 2 * j + 798 <= length(part) THEN md5(substr(part, 2 * j - 1, 800)) END AS w
  FROM blocks, unnest(range(1, least(500, length(part) // 2) + 1)) AS r(j)),
twice AS (SELECT w, true AS again FROM b WHERE w IS NOT NULL GROUP BY w HAVING count(*) > 1),
c AS (SELECT doc_id, i, x, coalesce(max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id ORDER BY i) >= i - 399, false) AS gone FROM b LEFT JOIN twice USING (w)),
d AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM c),
e AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS g, count(*) FILTER (begins) AS s, string_agg(x, '' ORDER BY i) FILTER (NOT gone) AS kept FROM d GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0) AS n_bytes, coalesce(g, 0) AS n_removed, coalesce(s, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM t LEFT JOIN e ON e.doc_id = t.doc_id
"""

#: crc32 of a number's decimal digits: one step per digit, eight per bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT)),
  lambda a, d: list_reduce(list_prepend(xor(a, d), list_value(0, 0, 0, 0, 0, 0, 0, 0)::UBIGINT[]),
    lambda b, z: xor(b >> 1, CASE WHEN b % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT)"""

SQL["op11_prefix_trie"] = rf"""
WITH t AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || coalesce(text, ''))) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, w, ({_CRC} % 4)::BIGINT AS h FROM t),
b AS (SELECT h.conv_id, list_concat(coalesce(t.w[1:h.h], []), h.w[h.h + 1:]) AS w FROM h LEFT JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, len(w) AS n, d, CASE WHEN d > 0 THEN len(regexp_extract_all(w[d].t, '[^ 	-
]+')) ELSE 0 END AS words,
    list_transform(range(0, d + 1), lambda i: md5(to_json(w[1:i])::VARCHAR)) AS names
  FROM b, unnest(range(0, len(w) + 1)) AS r(d)),
nodes AS (SELECT names[d + 1] AS name, any_value(names) AS names, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends FROM p GROUP BY names[d + 1], d),
kids AS (SELECT names[d] AS name, count(*) AS n FROM nodes WHERE d > 0 GROUP BY names[d]),
sums AS (SELECT a.name, count(*) FILTER (kids.n IS NULL) AS leaves, sum((n_convs - 1) * words)::BIGINT AS saved
  FROM nodes LEFT JOIN kids USING (name), unnest(names) AS a(name) GROUP BY a.name)
SELECT x.conv_id, x.d::BIGINT AS depth, y.conv_id AS parent_conv_id, x.n_convs, coalesce(kids.n, 0) AS n_children, sums.leaves AS n_leaves, sums.saved AS saved_tokens,
  sha256(coalesce(x.ends, '')) AS ends_sha256
FROM nodes x LEFT JOIN nodes y ON y.name = x.names[x.d] LEFT JOIN kids ON kids.name = x.name JOIN sums ON sums.name = x.name
"""


def _places(t: licenses.Template) -> str:
    return f"list_filter(range(1, len(w) + 1), lambda i: w[i:i + {len(t.words) - 1}] = {t.words})"


def _most(t: licenses.Template) -> str:
    blocks = f"range(0, (len(w) + {t.width - 1}) // {t.width})"
    return f"coalesce(list_max(list_transform({blocks}, lambda k: len(list_intersect({sorted(set(t.words))}, w[k * {t.width} + 1:k * {t.width} + {2 * t.width}])))), 0)"


_SHARES = ", ".join(f"CASE WHEN m{i} >= {t.needed} THEN m{i} / {len(set(t.words))} ELSE 0 END" for i, t in enumerate(licenses.MORE))
SQL["op13_license_scan"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
p AS (SELECT doc_id, w, {", ".join(f"{_places(t)} AS p{i}" for i, t in enumerate(licenses.BASE))}, {", ".join(f"{_most(t)} AS m{i}" for i, t in enumerate(licenses.MORE))} FROM d),
q AS (SELECT *, list_concat({", ".join(f"p{i}" for i in range(len(licenses.BASE)))}) AS p,
  list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{t.label}' END" for i, t in enumerate(licenses.BASE))}], lambda x: x IS NOT NULL) AS b,
  list_filter([{", ".join(f"CASE WHEN m{i} >= {t.needed} THEN '{t.label}' END" for i, t in enumerate(licenses.MORE))}], lambda x: x IS NOT NULL) AS c FROM p)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT - 1 AS first_word, list_max(p)::BIGINT - 1 AS last_word,
  array_to_string(list_sort(b), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(b, c))), ',') AS labels,
  greatest(CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, {_SHARES})::DOUBLE AS score
FROM q
"""
