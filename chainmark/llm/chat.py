"""Operator 2: chat formatting as prefix trees whose shared turns are emitted once.

A turn becomes ``### role:\\n`` text ``</turn>\\n``. Inside a role or text a backslash escapes backslashes, ``###``
and ``</turn>`` (in a role also colons), so control strings never appear unescaped and reading back is exact.

Conversations that share their first turns share the nodes of a tree; a node is named by a hash of all turns up to
it. Nodes are emitted once, depth-first, in one sequence of token ids: sorting by the path of segments (chains of
turns without forks) and by depth is that order, and offsets come from sums of range partitions. Each node carries

* ``start``: place of its first token in the sequence; ``position``: position id of that token, as if only its
  ancestors stood before it (token j of the node has position id ``position + j``);
* ``attend``: the ranges of its ancestors' tokens, outermost first, turns without a fork between them in one range;
  its own tokens also see those before them;
* ``loss_start``, ``loss_end``: its tokens under the loss mask, the text of an assistant's turn.

Turns are ordered by turn, role and text, nulls first; a null role or text is empty; rows with a null conv_id are one
conversation. Only conv_id, turn, role and text are read. No rows give no nodes. A node's path
and ranges are as long as its conversation has forks above it; each turn's text is held alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.llm.bpe import Decoder, Encoder
from chainmark.llm.joins import sized_join, stored

TRAINED_ROLE = "assistant"
_NAME = 16


def escaped(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")
    return text.replace(":", "\\:") if role else text


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and end of a turn."""
    return f"### {escaped(role, True)}:\n", escaped(text), "</turn>\n"


_TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n((?:\\.|(?!</turn>)[^\\])*)</turn>\n", re.S)


def parsed(text: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    out, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError("not a formatted turn")
        out.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return out


def _named_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, role, text, depth, name, parent)``: a name stands for a turn and all before it; one task reads a conversation in order."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, name, depth = object(), b"", 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != now:
                    now, name, depth = conv, b"", 0
                above, depth = name, depth + 1
                digest = hashlib.blake2b(above, digest_size=_NAME)
                digest.update(f"{len(role)}:{role}{text}".encode())
                name = digest.digest()
                out.append((depth, name, above))
            depths, names, parents = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(depths, pa.int64()), pa.array(names, pa.binary()), pa.array(parents, pa.binary())],
                ["conv_id", "role", "text", "depth", "name", "parent"])

    kinds = {"role": T.StringType(), "text": T.StringType(), "depth": T.LongType(), "name": T.BinaryType(), "parent": T.BinaryType()}
    return ordered.mapInArrow(run, T.StructType([turns.schema["conv_id"], *(T.StructField(c, k) for c, k in kinds.items())]))


def _paths(turns: DataFrame, forks: DataFrame) -> DataFrame:
    """``(name, path, depth)`` of each node; a path names the segments down to the node's own.

    A segment is a chain of turns without forks, so paths are as long as a conversation has forks, not turns.
    """
    marked = sized_join(turns.select("conv_id", "depth", "name", "parent"), forks.select("parent", F.lit(True).alias("fork")), ["parent"], "left")
    ordered = marked.select("conv_id", "depth", "name", "fork").repartition("conv_id").sortWithinPartitions("conv_id", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = b""
        for batch in batches:
            paths = []
            for depth, name, fork in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                path = name if depth == 1 else path + name if fork else path
                paths.append(path)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(paths, pa.binary()), batch.column(1)], ["name", "path", "depth"])

    return ordered.mapInArrow(run, "name binary, path binary, depth long").dropDuplicates(["name"])


def _encoded(nodes: DataFrame, path: str) -> DataFrame:
    """Token ids of each named turn, and which of them are under the loss mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(path, special=False)
        for batch in batches:
            roles, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for lo in range(0, len(roles), 256):
                parts = [p for r, t in zip(roles[lo:lo + 256], texts[lo:lo + 256]) for p in formatted(r, t)]
                ids, at = coder.encode(parts)
                ends = at[::3]
                trained = np.array([r == TRAINED_ROLE for r in roles[lo:lo + 256]])
                body, stop = at[1::3] - ends[:-1], at[2::3] - ends[:-1]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, 256), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32())),
                    pa.array(np.where(trained, body, 0)), pa.array(np.where(trained, stop, 0))], ["name", "ids", "loss_start", "loss_end"])

    return nodes.select("name", "role", "text").mapInArrow(run, "name binary, ids array<int>, loss_start long, loss_end long")


def _placed(encoded: DataFrame) -> DataFrame:
    """Nodes in depth-first order with ``start``, the number of tokens before them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = np.diff(np.asarray(batch.column(batch.schema.get_field_index("ids")).offsets)).astype(np.int64)
            local = total + np.cumsum(size) - size
            total += int(size.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(size), part)), pa.array(size), pa.array(local)],
                                             [*batch.schema.names, "part", "size", "local"])

    parts = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = encoded.repartitionByRange(parts, "path", "depth").sortWithinPartitions("path", "depth")
    kind = T.StructType([*encoded.schema.fields, *(T.StructField(c, T.LongType()) for c in ("part", "size", "local"))])
    placed = stored(ranged.mapInArrow(run, kind), "chat-placed")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.sum("size").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    return placed.join(F.broadcast(offsets), "part").withColumn("start", F.col("base") + F.col("local")).drop("part", "base", "local")


def prefix_trees(conversations: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The nodes ``(node, tree, depth, segment, start, size, position, attend, ids, loss_start, loss_end)`` and the
    last node of each conversation ``(conv_id, n_turns, node, start)``; ``segment`` is where the node's segment starts."""
    turns = stored(_named_turns(conversations), "chat-turns")
    nodes = turns.select("name", "role", "text").dropDuplicates(["name"])
    forks = turns.select("parent", "name").distinct().groupBy("parent").agg(F.count(F.lit(1)).alias("n")).where(F.octet_length("parent") > 0).where("n > 1")
    paths = _paths(turns, stored(forks, "chat-forks"))
    placed = stored(_placed(_encoded(nodes, path).join(paths, "name")), "chat-nodes")
    segments = placed.groupBy("path").agg(F.min("start").alias("a"), F.sum("size").alias("n"))
    segments = stored(segments.withColumn("segment", F.substring("path", -_NAME, _NAME)), "chat-segments")
    count = (F.octet_length("path") / _NAME).cast("int")
    above = F.transform(F.sequence(F.lit(1), count - 1), lambda i: F.substring(F.col("path"), (i - 1) * _NAME + 1, F.lit(_NAME)))
    line = segments.where(count > 1).select("path", F.posexplode(above).alias("level", "segment"))
    # A tree's first segment is above all of its segments; adaptive execution splits such a key.
    seen = line.join(segments.select("segment", "a", "n"), "segment")
    ranges = seen.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("level", "a", "n"))).alias("r")).select(
        "path", F.aggregate("r", F.lit(0).cast("long"), lambda t, x: t + x["n"]).alias("before"),
        F.transform("r", lambda x: F.struct(x["a"].alias("start"), (x["a"] + x["n"]).alias("end"))).alias("attend"))
    kind = "array<struct<start:long,end:long>>"
    known = segments.select("path", "a").join(ranges, "path", "left").select(
        "path", "a", F.coalesce("before", F.lit(0).cast("long")).alias("before"), F.coalesce("attend", F.array().cast(kind)).alias("attend"))
    own = F.when(F.col("start") > F.col("a"), F.array(F.struct(F.col("a").alias("start"), F.col("start").alias("end")))).otherwise(F.array().cast(kind))
    trees = sized_join(placed, stored(known, "chat-known"), ["path"]).select(
        F.col("name").alias("node"), F.substring("path", 1, _NAME).alias("tree"), "depth", F.col("a").alias("segment"), "start", "size",
        (F.col("before") + F.col("start") - F.col("a")).alias("position"), F.concat("attend", own).alias("attend"), "ids", "loss_start", "loss_end")
    trees = stored(trees, "chat-trees")
    leaves = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.max(F.struct("depth", "name")).alias("leaf"))
    leaves = stored(leaves.select("conv_id", "n_turns", F.col("leaf.name").alias("node")), "chat-ends")
    return trees, sized_join(leaves, trees.select("node", "start"), ["node"])


def read_back(trees: DataFrame, leaves: DataFrame, path: str) -> DataFrame:
    """Digests of each conversation, read from the token sequence: a last node's attention ranges hold the turns before it."""
    wanted = stored(leaves.select("node").distinct(), "chat-leaves")
    ends = sized_join(trees.select("node", "segment", "start", "size", "attend"), wanted, ["node"], "left_semi")
    # Each range lies in the segment at whose start it starts; the last one is prolonged by the node itself.
    earlier = F.filter("attend", lambda x: x["start"] != F.col("segment"))
    last = F.array(F.struct(F.col("segment").alias("start"), (F.col("start") + F.col("size")).alias("end")))
    places = ends.select(F.col("start").alias("leaf"), F.explode(F.concat(earlier, last)).alias("r")).select("leaf", F.col("r.start").alias("segment"), F.col("r.end").alias("end"))
    turns = places.join(trees.select("segment", "start", "position", "ids", "loss_start", "loss_end"), "segment").where(F.col("start") < F.col("end"))
    ordered = turns.select("leaf", "position", "start", "ids", "loss_start", "loss_end").repartition("leaf").sortWithinPartitions("leaf", "position", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, now, state = Decoder(path), None, None

        def result() -> list[tuple]:
            return [] if state is None else [(now, state[0].hexdigest(), state[1], state[2].hexdigest(), state[3])]

        for batch in batches:
            out: list[tuple] = []
            leaf, begin, end = (batch.column(i).to_numpy() for i in (0, 4, 5))
            at = np.asarray(batch.column(3).offsets).astype(np.int64)
            ids = np.asarray(batch.column(3).flatten()).astype(np.int64)
            at -= at[0]
            for i, (text, one) in enumerate(zip(coder.decode(ids, at), leaf.tolist())):
                if one != now:
                    out += result()
                    now, state = one, [hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parsed(text):
                    state[0].update(f"{role}\n{body}\n".encode())
                loss = unescaped(coder.decode(ids[at[i] + begin[i]:at[i] + end[i]], np.array([0, end[i] - begin[i]]))[0])
                state[1] += len(loss)
                state[2].update(loss.encode())
                state[3] += len(text)
            if out:
                yield _digests(out)
        if state is not None:
            yield _digests(result())

    digests = stored(ordered.mapInArrow(run, "start long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"), "chat-digests")
    return sized_join(leaves, digests, ["start"]).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["start", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
