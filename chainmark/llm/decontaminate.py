"""Operator 1: benchmark decontamination by a size-partitioned MinHash containment search. DataFrame functions only.

Words are lower-cased runs of letters, marks and digits; an item's set is its distinct shingles of five words, or
its whole sequence where it has fewer. An item is found in a document that holds at least ``percent`` of its set.

* Items are partitioned by set size in powers of two. A partition with sets of at most U shingles keeps the
  ``U - ceil(U * percent / 100) + 1`` lowest hash values of each set. A document that holds enough of a set misses
  too few of its shingles to miss all of these, so probing with the document's shingles loses nothing, however
  long the document is: no Jaccard similarity, which falls with the length, is involved.
* Candidates are verified by exact containment, shingle text against shingle text.

Null and empty texts, and items without words, match nothing. Repeated rows count once: there is one row per
(doc_id, item_id), with the best containment of texts that share these ids; null ids are ids of their own. Only
the id and text columns are read. Without documents or items the result is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.llm.joins import NO_ID, id_key, sized_join, stored

SHINGLE, PERCENT = 5, 80


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), "")


def _at(i: Column, n: int) -> list[Column]:
    """The n words from position i on."""
    return [F.get("words", i + k) for k in range(n)]


def _runs(df: DataFrame, n: int) -> DataFrame:
    """One row per position at which n words start; the words stay as a column."""
    fits = df.where(F.size("words") >= n)
    return fits.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("words") - n)))


def _shingles(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    return _runs(df, n).select(*keys, F.lit(n).alias("width"), F.concat_ws(" ", *_at(F.col("i"), n)).alias("shingle"))


def item_shingles(items: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(item, item_id, n, width, shingle)``: the set of each item, and its size."""
    named = items.select("item_id", word_list(F.col("text")).alias("words"))
    named = named.withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item"])
    short = [_shingles(named.where(F.size("words") == k), k, ["item", "item_id"]) for k in range(1, shingle)]
    sets = reduce(DataFrame.unionByName, short, _shingles(named, shingle, ["item", "item_id"])).distinct()
    return sets.join(sets.groupBy("item").agg(F.count(F.lit(1)).alias("n")), "item")


def _hash(n: int) -> Column:
    return F.xxhash64(*_at(F.col("i"), n))


def minimal_hashes(sets: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``(hash, width, item)``: the lowest hash values of each set, as many as its size partition needs."""
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("long") - 1
    keep = largest - F.ceil(largest * percent / 100).cast("long") + 1
    part = F.split("shingle", " ")
    hashed = F.coalesce(*[F.when(F.col("width") == k, F.xxhash64(*[F.get(part, F.lit(j)) for j in range(k)])) for k in range(1, shingle + 1)])
    ranked = sets.groupBy("item", "width").agg(F.sort_array(F.collect_list(hashed)).alias("all"), F.first(keep).alias("keep"))
    return ranked.select("item", "width", F.explode(F.slice("all", F.lit(1), F.col("keep").cast("int"))).alias("hash")).distinct()


def matches(docs: DataFrame, items: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``(_id, _text, item_id, n, n_shared)`` of each item found in a text."""
    sets = stored(item_shingles(items, shingle), "items")
    widths = sorted(r.width for r in sets.select("width").distinct().collect())  # at most ``shingle`` values
    minimal = stored(minimal_hashes(sets, percent, shingle), "item-minima")
    texts = docs.select(id_key().alias("_id"), F.xxhash64("text").alias("_text"), word_list(F.col("text")).alias("words"))
    hits = [
        sized_join(_runs(texts, w).select("_id", "_text", _hash(w).alias("hash")), minimal.where(F.col("width") == w).select("hash", "item"), ["hash"])
        for w in widths
    ]
    if not hits:
        hits = [texts.where("false").select("_id", "_text", F.lit(0).cast("long").alias("item"))]
    pairs = reduce(DataFrame.unionByName, [h.select("_id", "_text", "item") for h in hits]).distinct()
    asked = stored(pairs.groupBy("_id", "_text").agg(F.collect_list("item").alias("asked")), "item-candidates")
    found = sized_join(texts, asked, ["_id", "_text"]).dropDuplicates(["_id", "_text"])
    checked = [
        sized_join(_shingles(found, w, ["_id", "_text", "asked"]), sets.where(F.col("width") == w).select("item", "item_id", "n", "shingle"), ["shingle"])
        .where(F.array_contains("asked", F.col("item"))).select("_id", "_text", "item", "item_id", "n", "shingle")
        for w in widths
    ]
    if not checked:
        checked = [sets.select(F.lit(0).cast("long").alias("_id"), F.lit(0).cast("long").alias("_text"), "item", "item_id", "n", "shingle")]
    shared = reduce(DataFrame.unionByName, checked).groupBy("_id", "_text", "item", "item_id", "n").agg(F.count_distinct("shingle").alias("n_shared"))
    return shared.where(F.col("n_shared") * 100 >= F.col("n") * percent)


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item, containment)`` of each item found in a document."""
    found = matches(docs, items, percent, shingle)
    best = found.groupBy("_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n")).alias("containment"), "n_shared", "n")).alias("b"))
    doc_id = F.when(F.col("_id") != NO_ID, F.col("_id")).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return best.select(doc_id, "item_id", F.col("b.n_shared").alias("n_shared"), F.col("b.n").alias("n_item"), F.col("b.containment").alias("containment"))


def without_benchmark(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    found = stored(matches(docs, items, percent).select(F.col("_id").alias("_llm_id"), F.col("_text").alias("_llm_text")).distinct(), "contaminated")
    keyed = docs.withColumns({"_llm_id": id_key(), "_llm_text": F.xxhash64("text")})
    return sized_join(keyed, found, ["_llm_id", "_llm_text"], "left_anti").select(*docs.columns)
