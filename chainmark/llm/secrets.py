"""Operator 10: secrets in texts, found through a trigram inverted index. DataFrame functions only.

* From each rule's regular expression a Boolean trigram query is derived: alternatives of trigram sets, one of
  which every match contains, in lower case.
* The index holds postings (trigram, document) for the trigrams that queries name. A document is a candidate of a
  rule when its postings cover one of the alternatives. Rules without mandatory trigrams scan all texts.
* Candidates are verified with the expression itself. Start and end, in code points, come from the lengths of the
  matches and of the text between them.

Null text is empty. Every row is kept, also with null or repeated ids. Only doc_id and text are read. An empty
table gives an empty result.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.llm.joins import id_key, sized_join, stored

#: At most so many strings stand for the beginning of an expression while trigrams are derived.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``group`` is what must have ``least`` characters; a match that fails is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


def _product(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a in left for b in right} if len(left) * len(right) <= MAX_STRINGS else None


def _strings(node) -> set[str] | None:
    """All strings that a part of an expression stands for, if they are few."""
    op, value = node
    if op is kinds.LITERAL:
        return {chr(value).lower()}
    if op is kinds.IN:
        if value and value[0][0] is kinds.NEGATE:
            return None
        chars = [range(v[0], v[1] + 1) if k is kinds.RANGE else [v] if k is kinds.LITERAL else None for k, v in value]
        if any(c is None for c in chars) or sum(map(len, chars)) > 8:
            return None
        return {chr(x).lower() for c in chars for x in c}
    if op is kinds.SUBPATTERN:
        return _whole(value[3])
    if op is kinds.BRANCH:
        every = [_whole(part) for part in value[1]]
        return None if any(s is None for s in every) else set().union(*every)
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[1] <= 3 and (once := _whole(value[2])) is not None:
        out, now = set(), {""}
        for k in range(value[1] + 1):
            out |= now if k >= value[0] else set()
            if (now := _product(now, once)) is None:
                return None
        return out
    return None


def _whole(nodes) -> set[str] | None:
    now: set[str] | None = {""}
    for node in nodes:
        more = _strings(node)
        now = None if more is None or now is None else _product(now, more)
        if now is None or len(now) > MAX_STRINGS:
            return None
    return now


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams, one of which every match holds; none where the expression has no such trigrams."""
    best: list[frozenset[str]] = []

    def offer(strings: set[str]) -> None:
        nonlocal best
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if all(sets) and (not best or sum(map(len, sets)) / len(sets) > sum(map(len, best)) / len(best)):
            best = sorted((a for a in sets if not any(b < a for b in sets)), key=sorted)  # a larger set says no more

    def walk(nodes) -> None:
        now = {""}
        for node in nodes:
            more = _strings(node)
            joined = None if more is None else _product(now, more)
            if joined is not None:
                now = joined
                continue
            offer(now)
            now = more if more is not None else {""}
            if more is None and node[0] is kinds.SUBPATTERN:
                walk(node[1][3])
            elif more is None and node[0] in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and node[1][0] > 0:
                walk(node[1][2])
        offer(now)

    walk(parser.parse(pattern))
    return best


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``(trigram, _id, _text)``: which of the trigrams each text holds, in lower case."""
    lowered = docs.select(id_key().alias("_id"), F.xxhash64("text").alias("_text"), F.lower("text").alias("_low"))
    held = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(g)), F.lit(g)) for g in trigrams]))
    return lowered.select("_id", "_text", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(_id, _text, _asked)``: the rules whose trigram query each document's postings satisfy."""
    spark = docs.sparkSession
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = [(kind, n, g, len(grams)) for kind, sets in queries.items() for n, grams in enumerate(sets) for g in sorted(grams)]
    asked = spark.createDataFrame(wanted or [("", 0, "", 1)], "kind string, alternative int, trigram string, needed int")
    index = postings(docs, sorted({w[2] for w in wanted})) if wanted else postings(docs.limit(0), ["-"])
    met = index.join(F.broadcast(asked), "trigram")  # asked has one row per trigram of a rule
    covered = met.groupBy("_id", "_text", "kind", "alternative", "needed").agg(F.count_distinct("trigram").alias("n")).where("n = needed")
    return covered.groupBy("_id", "_text").agg(F.collect_set("kind").alias("_asked"))


def _spans(rule: Rule, order: int) -> Column:
    """Spans of a rule in the column ``_body``, as (start, order, end)."""
    pattern, body = F.lit(rule.pattern), F.col("_body")
    whole = F.regexp_extract_all(body, pattern, F.lit(0))
    judged = F.regexp_extract_all(body, pattern, F.lit(rule.group)) if rule.group else whole
    rows = F.arrays_zip(whole.alias("w"), judged.alias("g"), F.split(body, rule.pattern, -1).alias("p"))
    kind = "array<struct<start:int,ord:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, row: Column) -> Column:
        begin = acc["at"] + F.length(row["p"])
        end = begin + F.length(row["w"])
        span = F.array(F.struct(begin.alias("start"), F.lit(order).alias("ord"), end.alias("end")))
        return F.struct(F.coalesce(end, begin).alias("at"), F.when(F.length(row["g"]) >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(rows, start, step, lambda acc: acc["out"])


def with_spans(docs: DataFrame, rules: tuple[Rule, ...], columns: list[str]) -> DataFrame:
    """The given columns, ``_body`` (the text, empty where null) and ``_spans``: (start, ord, end), sorted; ``ord`` numbers the rules."""
    asked = stored(candidates(docs, rules), "secret-candidates")
    keyed = docs.select(*columns, F.coalesce("text", F.lit("")).alias("_body"), id_key().alias("_id"), F.xxhash64("text").alias("_text"))
    texts = sized_join(keyed, asked, ["_id", "_text"], "left")
    none = F.array().cast("array<struct<start:int,ord:int,end:int>>")
    found = []
    for n, rule in enumerate(rules):
        maybe = F.coalesce(F.array_contains("_asked", rule.kind), F.lit(False)) if trigram_query(rule.pattern) else F.lit(True)
        found.append(F.when(maybe & F.col("_body").rlike(rule.pattern), _spans(rule, n)).otherwise(none))
    return texts.select(*columns, "_body", F.sort_array(F.concat(*found)).alias("_spans"))


def _listed(found: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    each = F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["ord"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    found = with_spans(docs, rules, ["doc_id"])
    ords = F.transform("_spans", lambda s: s["ord"])
    count = [(F.size(ords) - F.size(F.array_remove(ords, n))).cast("long").alias(f"n_{rules[n].kind}") for n in range(base)]
    first = F.filter("_spans", lambda s: s["ord"] < base)
    return found.select("doc_id", *count, F.sha2(_listed(first, rules).cast("binary"), 256).alias("base_sha256"), _listed(F.col("_spans"), rules).alias("spans"))


def masked(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, mark: str = "[SECRET]") -> DataFrame:
    """All columns of the documents, with every span of ``text`` replaced by ``mark``; spans that overlap become one."""
    found = with_spans(docs, rules, docs.columns)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring("_body", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(F.col("_body"), acc["at"] + 1, F.length("_body")))

    text = F.when(F.col("text").isNotNull() & (F.size("_spans") > 0), F.aggregate("_spans", start, step, rest)).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*docs.columns)
