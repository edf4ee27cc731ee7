"""Operator 6: near-duplicate documents by SuperMinHash, banding, exact verification and grouping.

* A signature has ``ROWS * BANDS`` registers. In round j each shingle draws a rank in [j, j + 1) and the next
  place of its own random permutation of the registers, so that ranks of one shingle differ between registers;
  a register keeps its lowest rank. A text stops early, once no later round can lower any register.
* Texts with equal shingle sets are one class from here on, so copies cost one row each and nothing more.
* Classes that agree in a band share a bucket, and classes connected through buckets are a cluster. Buckets do not
  emit their pairs. In clusters above ``BLOCK`` classes each class meets the best connected class of each of its
  buckets first, and what links is grouped. Classes of a cluster that are still in different groups are compared in
  blocks of bounded size; a block returns a spanning forest of its links, never pairs. No link that joins two groups
  is lost. At similarity 0.85 a pair shares no bucket with chance 5e-7.
* A link needs ``100 * shared >= PERCENT * union`` on the full sets of 64-bit shingle names.

Null or empty texts have no shingles and link with nothing. A repeated or null doc_id is a document of its own
where texts differ; the class id is the smallest non-null doc_id. Only doc_id and text are read. An empty table
gives an empty result. Class names are 64-bit hashes of the whole set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.llm.joins import id_key, sized_join, stored
from chainmark.llm.text import FOLDED, draws, flat, list_array, mix, rounds, shingle_sets, words
from chainmark.operators.topology import components

ROWS, BANDS = 5, 25
PERCENT, SHINGLE = 85, 3
#: Classes of a cluster that are compared in one task, and the most cells of the table in which they are.
BLOCK, MATRIX_BITS = 400, 1 << 26


def superminhash(values: np.ndarray, first: np.ndarray, registers: int) -> np.ndarray:
    """Signatures (texts x registers) of the sets ``values[first[i]:first[i + 1]]``; infinite where a set is empty."""
    texts = len(first) - 1
    low = np.full((texts, registers), np.inf)
    text = np.repeat(np.arange(texts), np.diff(first))
    order = None
    for j in range(registers):
        if not len(values):
            break
        noise = mix(values + draws(1, 7, j)[0])
        rank = j + (noise >> np.uint64(11)).astype(np.float64) * 2.0**-53
        pick = j + (mix(noise ^ draws(1, 8, j)[0]) % np.uint64(registers - j)).astype(np.int64)
        if order is None:
            register = pick
        else:
            row = np.arange(len(values))
            register = order[row, pick].astype(np.int64)
            order[row, pick] = order[row, j]
            order[row, j] = register
        np.minimum.at(low.reshape(-1), text * registers + register, rank)
        going = (low.max(axis=1) >= j + 1)[text]
        if j == 0:
            order = np.tile(np.arange(registers, dtype=np.uint8 if registers <= 256 else np.int32), (int(going.sum()), 1))
            row = np.arange(len(order))
            order[row, pick[going]] = 0
            order[row, 0] = pick[going]
        elif not going.all():
            order = order[going]
        values, text = values[going], text[going]
    return low


def band_names(low: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit name for each band of each signature."""
    bits = mix(low.view(np.uint64)).reshape(len(low), bands, rows)
    factor = (draws(rows * bands, 9) | np.uint64(1)).reshape(bands, rows)
    return mix((bits * factor).sum(axis=2, dtype=np.uint64) + draws(bands, 10))


def _set_name(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Name of each set, from the sum of its members' names and its size."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ draws(1, 11)[0]), dtype=np.uint64)))
    return mix((total[first[1:]] - total[first[:-1]]) ^ mix(np.diff(first).astype(np.uint64) + np.uint64(1)))


def _sets(batch: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = flat(batch.column(1))
    for lo, hi in rounds(offsets):
        at = offsets[lo:hi + 1] - offsets[lo]
        _, _, names, first = words(data[offsets[lo]:offsets[hi]], at, FOLDED)
        yield lo, hi, *shingle_sets(names, first, shingle)


def signatures(docs: DataFrame, rows: int = ROWS, bands: int = BANDS, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, _text, n_shingles, cls, bands)``; ``_text`` hashes the text, ``cls`` names the whole set and is null where it is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, values, first in _sets(batch, shingle):
                some = np.diff(first) > 0
                low = superminhash(values, np.append(first[:-1][some], first[-1]), rows * bands)
                where = np.concatenate(([0], np.cumsum(some * bands)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(np.diff(first)),
                    pa.array(_set_name(values, first).view(np.int64), mask=~some),
                    list_array(band_names(low, rows, bands).reshape(-1).view(np.int64), where, pa.int64()),
                ], ["doc_id", "_text", "n_shingles", "cls", "bands"])

    long = [T.StructField(c, T.LongType()) for c in ("_text", "n_shingles", "cls")]
    kind = T.StructType([docs.schema["doc_id"], *long, T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.select("doc_id", "text", F.xxhash64("text").alias("_text")).mapInArrow(run, kind)


def shingle_names(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(cls, names)``: the full sets of the given documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, first in _sets(batch, shingle):
                yield pa.RecordBatch.from_arrays([
                    pa.array(_set_name(values, first).view(np.int64)), list_array(values.view(np.int64), first, pa.int64())], ["cls", "names"])

    return docs.select("doc_id", "text").mapInArrow(run, "cls long, names array<long>")


def shared_counts(values: np.ndarray, first: np.ndarray):
    """A function of (one set, others) that counts the members they share; sets are ``values[first[i]:first[i + 1]]``."""
    size = np.diff(first)
    _, member, times = np.unique(values, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1  # members of one set only are shared by no pair
    wide = int(column[-1]) + 1 if len(column) else 0
    if len(size) * wide > MATRIX_BITS:
        def merged(a: int, others: np.ndarray) -> np.ndarray:
            mine = values[first[a]:first[a + 1]]
            return np.array([len(np.intersect1d(mine, values[first[b]:first[b + 1]], assume_unique=True)) for b in others], np.int64)
        return merged
    kept = times[member] > 1
    bits = np.zeros((len(size), wide), bool)
    bits[np.repeat(np.arange(len(size)), size)[kept], column[member[kept]]] = True
    packed = np.packbits(bits, axis=1)
    return lambda a, others: np.bitwise_count(packed[others] & packed[a]).sum(axis=1, dtype=np.int64)


def _joins(table: pa.Table, percent: int) -> pa.RecordBatch:
    """Links ``(u, v)`` that join the groups of one block, a spanning forest of all links between them."""
    cls, side, split, grp = (table.column(i).to_numpy() for i in (1, 2, 3, 4))
    lists = table.column(5).combine_chunks()
    values, first = np.asarray(lists.flatten()), np.asarray(lists.offsets).astype(np.int64)
    first = first - first[0]
    size, root = np.diff(first), np.unique(grp, return_inverse=True)[1]
    count, found = shared_counts(values, first), []
    for a in range(len(cls) - 1):  # one row against all later ones that are not joined to it yet
        b = np.arange(a + 1, len(cls))
        fits = (root[b] != root[a]) & (cls[b] != cls[a]) & (~split[a] | (side[b] != side[a]))
        b = b[fits & (np.minimum(size[b], size[a]) * 100 >= np.maximum(size[b], size[a]) * percent)]
        if not len(b):
            continue
        shared = count(a, b)
        for k in b[shared * 100 >= (size[a] + size[b] - shared) * percent]:
            if root[k] != root[a]:
                found.append((cls[a], cls[k]))
                root[root == root[k]] = root[a]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["u", "v"])


def _block_links(rows: DataFrame, percent: int) -> DataFrame:
    """``(u, v)`` of all blocks; rows ``(block, cls, side, split, grp, names)`` lie sorted by block and class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and held[-1].column(0)[0].as_py() != block[lo]:
                    yield _joins(pa.Table.from_batches(held), percent)
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield _joins(pa.Table.from_batches(held), percent)

    return rows.select("block", "cls", "side", "split", "grp", "names").mapInArrow(run, "u long, v long")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``(cls, names)`` of the classes ``(cls, rep)``, once or, where a doc_id repeats, several times each."""
    ids = stored(wanted.select(F.col("rep").alias("_id")).distinct(), "near-ids")
    texts = sized_join(docs.select("doc_id", "text").withColumn("_id", id_key()), ids, ["_id"], "left_semi")
    return stored(sized_join(shingle_names(texts, shingle), wanted.select("cls"), ["cls"], "left_semi"), "near-sets")


def links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` between classes that join the same groups as all links would."""
    keyed = classes.select("cls", F.explode("bands").alias("bucket"))
    crowded = stored(keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-buckets")
    members = stored(sized_join(keyed, crowded, ["bucket"]), "near-members")
    # The head of a bucket is its best connected class; all that share buckets are one cluster.
    score = members.groupBy("cls").agg(F.sum("size").alias("score"))
    ranked = members.join(score, "cls").select("bucket", "cls", "score")
    head = ranked.groupBy("bucket").agg(F.max(F.struct("score", "cls")).alias("best")).select("bucket", F.col("best.cls").alias("v"))
    stars = stored(members.join(head, "bucket").where("cls != v").select(F.col("cls").alias("u"), "v").distinct(), "near-stars")
    clusters = components(stars.select(F.explode(F.array("u", "v")).alias("v")).distinct(), stars)
    clusters = stored(clusters.select(F.col("v").alias("cls"), F.col("root").alias("cluster")), "near-clusters")
    sizes = stored(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "near-cluster-sizes")
    placed = stored(sized_join(clusters, sizes, ["cluster"]).join(classes.select("cls", "rep"), "cls"), "near-placed")
    sets = _full_sets(docs, placed, shingle)

    # Large clusters: every class meets the heads of its buckets, so that most are joined before blocks are compared.
    large = stored(placed.where(F.col("n") > block).select("cls"), "near-large")
    asked = sized_join(stars.withColumnRenamed("u", "cls"), large, ["cls"], "left_semi").withColumnRenamed("cls", "u")
    one = sets.dropDuplicates(["cls"])
    both = asked.join(one.select(F.col("cls").alias("u"), F.col("names").alias("su")), "u").join(one.select(F.col("cls").alias("v"), F.col("names").alias("sv")), "v")
    shared = F.size(F.array_intersect("su", "sv")).cast("long")
    first = stored(both.where(shared * 100 >= (F.size("su") + F.size("sv") - shared) * percent).select("u", "v"), "near-first")
    groups = stored(components(first.select(F.explode(F.array("u", "v")).alias("v")).distinct(), first).select(F.col("v").alias("cls"), F.col("root").alias("grp")), "near-groups")

    # What is still apart in a cluster is compared in blocks: a cluster is cut into sides, each pair of sides is a block.
    known = stored(sized_join(placed, groups, ["cls"], "left").withColumn("grp", F.coalesce("grp", "cls")), "near-known")
    apart = stored(known.groupBy("cluster").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a != b").select("cluster"), "near-apart")
    ways = F.ceil(F.col("n") / block).cast("int")
    sided = sized_join(known, apart, ["cluster"], "left_semi").withColumn("side", F.pmod(F.xxhash64("cls"), ways).cast("int"))
    dealt = sided.withColumn("other", F.explode(F.sequence(F.lit(0), ways - 1))).select(
        F.xxhash64("cluster", F.least("side", "other"), F.greatest("side", "other")).alias("block"), "cls", "side", (F.col("side") != F.col("other")).alias("split"), "grp")
    blocks = sets.join(stored(dealt, "near-dealt"), "cls").repartition("block").sortWithinPartitions("block", "cls")
    return stored(first.unionByName(_block_links(blocks, percent)), "near-links")


def grouped(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, rows: int = ROWS, bands: int = BANDS, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed documents, their classes, and the root class of each class that has a link."""
    signed = stored(signatures(docs, rows, bands, shingle), "near-signed")
    classes = stored(
        signed.where("cls is not null").groupBy("cls")
        .agg(F.min("n_shingles").alias("n"), F.min("doc_id").alias("smallest"), F.first("bands").alias("bands"))
        .withColumn("rep", id_key("smallest")), "near-sigs")
    found = links(docs, classes, percent, shingle, block)
    linked = found.select(F.explode(F.array("u", "v")).alias("v")).distinct()
    return signed, classes, components(linked, found).select(F.col("v").alias("cls"), "root")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, rows: int = ROWS, bands: int = BANDS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document."""
    signed, classes, groups = grouped(docs, percent, shingle, rows, bands, block)
    smallest = groups.join(classes.select("cls", "smallest"), "cls").groupBy("root").agg(F.min("smallest").alias("component_id"))
    joined = groups.join(smallest, "root").select("cls", "component_id")
    named = stored(
        classes.select("cls", "smallest").join(joined, "cls", "left")
        .select(F.col("cls").alias("key"), F.coalesce("component_id", "smallest").alias("component_id")), "near-named")
    # Empty texts get a key of their own, so that they do not meet in one task.
    keyed = signed.select("doc_id", "n_shingles", "cls", F.coalesce("cls", F.xxhash64("doc_id")).alias("key"))
    out = sized_join(keyed, named, ["key"], "left")
    out = out.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 80, shingle: int = 5, rows: int = 4, bands: int = 32) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id. Texts without words all stay."""
    signed, _, groups = grouped(docs, percent, shingle, rows, bands)
    rooted = sized_join(signed.where("cls is not null").select("cls", id_key().alias("_id"), F.col("doc_id").isNull().alias("bare"), "_text"),
                        stored(groups, "near-groups"), ["cls"], "left").withColumn("root", F.coalesce("root", "cls"))
    rooted = stored(rooted.groupBy("root", "bare", "_id", "_text").agg(F.count(F.lit(1)).alias("times")), "near-rooted")
    first = stored(rooted.groupBy("root").agg(F.min(F.struct("bare", "_id", "_text")).alias("f")), "near-first")
    judged = sized_join(rooted, first, ["root"]).withColumn("stays", (F.col("f._id") == F.col("_id")) & (F.col("f._text") == F.col("_text")))
    dropped = stored(judged.where("not stays or times > 1").select(F.col("_id").alias("_llm_id"), F.col("_text").alias("_llm_text"), "stays"), "near-dropped")
    keyed = docs.withColumns({"_llm_id": id_key(), "_llm_text": F.xxhash64("text")})
    kept = sized_join(keyed, dropped.select("_llm_id", "_llm_text"), ["_llm_id", "_llm_text"], "left_anti").select(*docs.columns)
    again = dropped.where("stays").select("_llm_id", "_llm_text")
    if again.isEmpty():
        return kept
    once = sized_join(keyed, again, ["_llm_id", "_llm_text"], "left_semi").dropDuplicates(["_llm_id", "_llm_text"])
    return kept.unionByName(once.select(*docs.columns))
