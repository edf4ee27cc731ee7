"""Operator 11: the prefix trie of conversations, from the longest common prefixes of sorted neighbours.

A turn is named by 128 bits of its role and text; a conversation is the row of its turns' names, its path. Paths are
rebuilt from the first turns of the conversation that shares them, and sorted over range partitions. In sorted order
two neighbours are joined by an edge as deep as the turns they share. Each partition takes its edges in descending
depth through union-find: a merge of two components at a depth makes (or widens) the branching node of that depth,
and the turns between it and the node below are a chain of nodes with the same members.

A node that is no prefix of the partition's first or last path lies in this partition alone and is written at once. The
others are contracted: what hangs on the two outer paths is kept as numbers at depths. ``FANOUT`` neighbouring
partitions' contracted forests are then merged by the same procedure, again and again, until one forest is left; no task
sees more than that many pairs of paths. Nodes written before their parent was finished name it, and one measured join
fills in its number. Digests of members that span partitions are streamed over their pieces, in order.

* Rows with a null conv_id belong to no conversation and are left out. Null role or text is empty. Equal turn numbers are
  ordered by the turn's name, which does not depend on the order of rows. Repeated rows are turns of their own.
* Only conv_id, turn, role and text are read, so other columns cannot clash. No rows give no nodes.
* A conversation's path is one value of 20 bytes a turn; texts are never shuffled. A third of all conversations may be
  copies, or share their first turns: ranges are cut by path and number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainmark.llm.joins import stored
from chainmark.llm.text import SPACE, flat, rounds
from chainmark.operators.scale import lookup_join

#: Bytes of a turn in a path: 16 of its name and 4 for the words of its text, highest byte first.
ENTRY = 20
#: Bytes of paths that a partition holds, about.
PART_BYTES = 8 << 20
#: Contracted forests that one task merges.
FANOUT = 256
_ROWS = 16_384
_NONE = hashlib.sha256(b"").hexdigest()

_HUNG = pa.struct([(c, pa.binary() if c == "ends" else pa.int64()) for c in ("depth", "n", "low", "kids", "leaves", "saved", "ends")])
_KINDS = {
    "kind": pa.int8(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(),
    "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string(),
    "parent": pa.binary(), "ends": pa.binary(), "part": pa.int64(), "side": pa.int8(), "path": pa.binary(), "hung": pa.list_(_HUNG),
}
_SCHEMA = ("kind byte, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
           "ends_sha256 string, parent binary, ends binary, part long, side byte, path binary, "
           "hung array<struct<depth:long,n:long,low:long,kids:long,leaves:long,saved:long,ends:binary>>")
#: Kinds of rows that a merge writes: finished nodes, contracted paths, numbers of named nodes, pieces of member lists.
NODE, PATH, NAMED, PIECE = range(4)


def _word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of words of each text."""
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    total = np.concatenate(([0], np.cumsum(begin)))
    return np.diff(total[offsets])


def named_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, entry)``: a turn's name and the words of its text, 20 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(3))
            for lo, hi in rounds(offsets):
                count = _word_counts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                entries = []
                for role, text, n in zip(batch.column(2).slice(lo, hi - lo).to_pylist(), batch.column(3).slice(lo, hi - lo).to_pylist(), count.tolist()):
                    role, text = (role or "").encode(), (text or "").encode()
                    digest = hashlib.blake2b(b"%d:%b" % (len(role), role), digest_size=ENTRY - 4)
                    digest.update(text)
                    entries.append(digest.digest() + n.to_bytes(4, "big"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(entries, pa.binary())], ["conv_id", "turn", "entry"])

    given = conversations.where(F.col("conv_id").isNotNull())
    return given.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").mapInArrow(run, "conv_id long, turn long, entry binary")


def paths(named: DataFrame) -> DataFrame:
    """``(conv_id, path)``: the entries of each conversation in order, put together from pieces that whole ranges of rows make."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            begin = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            data, _ = flat(batch.column(1))
            at = np.append(begin, len(conv)).astype(np.int32) * ENTRY
            blobs = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv[begin]), pa.array(np.full(len(begin), part)), pa.array(np.arange(piece, piece + len(begin))), blobs],
                ["conv_id", "part", "piece", "blob"])
            piece += len(begin)

    order = ["conv_id", "turn", "entry"]
    parts = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = named.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "entry")
    pieces = ranged.mapInArrow(run, "conv_id long, part long, piece long, blob binary")
    # A conversation and the one it takes turns from share `base`, so one shuffle serves putting together and rebuilding.
    based = pieces.withColumn("base", F.col("conv_id") - F.col("conv_id") % 20).repartition(parts, "base")
    listed = based.groupBy("base", "conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "piece", "blob"))).alias("p"))
    return listed.select("base", "conv_id", F.aggregate("p", F.lit(bytearray()), lambda a, x: F.concat(a, x["blob"])).alias("path"))


def _turns(path: Column, skip: Column, take: Column) -> Column:
    return F.substring(path, (skip * ENTRY + 1).cast("int"), (take * ENTRY).cast("int"))


def rebuilt(whole: DataFrame) -> DataFrame:
    """Each conversation with its first h turns replaced by those of the conversation ``base`` of its twenty, h = crc32(number) % 4."""
    twenty = Window.partitionBy("base")  # at most 39 conversations: numbers from base - 19 to base + 19
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.substring("path", 1, 3 * ENTRY))).over(twenty)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    own = _turns(F.col("path"), h, F.lit((1 << 31) // ENTRY - 1))
    return whole.withColumn("head", F.coalesce(head, F.lit(bytearray()))).select("conv_id", F.concat(_turns(F.col("head"), F.lit(0), h), own).alias("path"))


class _Tree:
    """A component of sorted paths, and the node at ``depth`` that all of them share so far.

    ``open`` has bit 1 if the first path is among them and bit 2 for the last; an open node's numbers are only those of
    what hangs on it here. ``rest`` holds what hangs higher up, deepest last; ``waiting`` nodes lack their parent's number.
    """

    __slots__ = ("path", "depth", "open", "rest", "n", "low", "kids", "leaves", "saved", "ends", "waiting", "hung")

    def __init__(self, path: bytes, is_open: int, rest: list[tuple]):
        self.path, self.open, self.rest = path, is_open, rest
        self.begin(len(path) // ENTRY)

    def begin(self, depth: int) -> None:
        self.depth, self.n, self.low, self.kids, self.leaves, self.saved = depth, 0, None, 0, 0, 0
        self.ends, self.waiting, self.hung = None, [], False
        self.take()

    def take(self) -> None:
        """Take in what hangs at this depth."""
        while self.rest and self.rest[-1][0] == self.depth:
            _, n, low, kids, leaves, saved, ends = self.rest.pop()
            self.add(n, low, kids, leaves, saved, ends)
            self.hung |= kids > 0

    def add(self, n: int, low: int | None, kids: int, leaves: int, saved: int, ends: bytes | None) -> None:
        self.n, self.kids, self.leaves, self.saved = self.n + n, self.kids + kids, self.leaves + leaves, self.saved + saved
        self.low = low if self.low is None else self.low if low is None else min(self.low, low)
        self.ends = ends if self.ends is None else self.ends


class _Forest:
    """Merges sorted paths; collects finished nodes and the contracted outer paths."""

    def __init__(self, top: bool, digest: bool, part: int):
        #: ``top``: nothing is open any more; ``digest``: ``ends`` holds members themselves, not the name of their node.
        self.top, self.digest, self.part = top, digest, part
        self.batches: list[pa.RecordBatch] = []
        self.rows: list[tuple] = []
        self.spines: tuple[list, list] = ([], [])
        self.names: dict[bytes, list[bytes]] = {}

    def write(self, kind: int, row: tuple = (None,) * 8, above: int | None = None, parent: bytes | None = None,
              contracted: tuple = (None,) * 4) -> None:
        low, depth, n, kids, leaves, saved, text, ends = row
        self.rows.append((kind, low, depth, above, n, kids, leaves, saved, text, parent, ends, *contracted))
        if len(self.rows) >= _ROWS:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            columns = zip(*self.rows)
            self.batches.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS.values())], list(_KINDS)))
            self.rows = []

    def name(self, path: bytes, depth: int) -> bytes:
        """Name of the node at a depth of a path; all names of an outer path are made in one pass."""
        known = self.names.get(path)
        if known is None:
            state, known = hashlib.blake2b(digest_size=16), []
            known.append(state.digest())
            for at in range(0, len(path), ENTRY):
                state.update(path[at:at + ENTRY])
                known.append(state.copy().digest())
            self.names[path] = known
        return known[depth]

    def finish(self, t: _Tree) -> tuple:
        """The node's own numbers are final; the nodes below it get its number."""
        if t.kids == 0:
            t.leaves += 1
        if t.depth:
            t.saved += (t.n - 1) * int.from_bytes(t.path[t.depth * ENTRY - 4:t.depth * ENTRY], "big")
        for row in t.waiting:
            self.write(NODE, row, t.low)
        if t.hung:
            self.write(NAMED, (t.low, *[None] * 7), parent=self.name(t.path, t.depth))
        text = _NONE if t.ends is None else hashlib.sha256(t.ends).hexdigest() if self.digest else None
        return (t.low, t.depth, t.n, t.kids, t.leaves, t.saved, text, None if self.digest else t.ends)

    def keep(self, t: _Tree) -> None:
        """Contract an open node to what hangs on it."""
        if t.waiting:
            name = self.name(t.path, t.depth)
            for row in t.waiting:
                self.write(NODE, row, parent=name)
        if t.n:
            ends = t.ends
            if ends is not None and self.digest:
                ends = self.name(t.path, t.depth)
                self.write(PIECE, (*[None] * 7, ends), contracted=(self.part, None, t.ends, None))
            self.spines[0 if t.open & 1 else 1].append((t.depth, t.n, t.low, t.kids, t.leaves, t.saved, ends))

    def lift(self, t: _Tree, depth: int) -> None:
        """Bring the component's node up to a depth."""
        while t.depth > depth:
            if t.open and not self.top:
                self.keep(t)
                t.begin(max(depth, t.rest[-1][0] if t.rest else 0))
            else:
                row = self.finish(t)
                t.depth, t.kids, t.ends, t.waiting, t.hung = t.depth - 1, 1, None, [row], False
                t.take()

    def merge(self, items: list[tuple[bytes, list[tuple]]]) -> None:
        """Union-find over the edges between neighbours, deepest first; ``items`` are sorted paths with what hangs on them."""
        last = len(items) - 1
        trees = [_Tree(p, (i == 0) | (i == last) << 1, sorted(h, key=lambda x: x[0])) for i, (p, h) in enumerate(items)]
        up = list(range(len(items)))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        edges = sorted(((_common(items[i][0], items[i + 1][0]), i) for i in range(last)), key=lambda e: (-e[0], e[1]))
        for depth, i in edges:
            a, b = find(i), find(i + 1)
            up[b] = a
            one, two = trees[a], trees[b]
            trees[b] = None
            self.lift(one, depth)
            self.lift(two, depth)
            one.add(two.n, two.low, two.kids, two.leaves, two.saved, two.ends)
            small, large = sorted((one.waiting, two.waiting), key=len)
            large.extend(small)
            one.waiting = large
            one.hung |= two.hung
            if two.open and not one.open:
                one.path = two.path
            one.open |= two.open
            if two.rest:
                one.rest = sorted(one.rest + two.rest, key=lambda x: x[0])
        root = trees[find(0)]
        self.lift(root, 0)
        if self.top:
            self.write(NODE, self.finish(root))
        else:
            self.keep(root)
            first, end = items[0][0], items[-1][0]
            for side, path in [(0, first)] + ([(1, end)] if end != first else []):
                self.write(PATH, contracted=(self.part, side, path, self.spines[side]))
        self.flush()


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    n = 0
    while n < len(a) and n < len(b) and a[n:n + ENTRY] == b[n:n + ENTRY]:
        n += ENTRY
    return n // ENTRY


def _partition_forest(ordered: DataFrame, top: bool) -> DataFrame:
    """The forest of each sorted partition of ``(path, conv_id)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[list] = []
        for batch in batches:
            for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if items and items[-1][0] == path:
                    items[-1][1].append(conv)
                else:
                    items.append([path, [conv]])
        if items:
            forest = _Forest(top, True, TaskContext.get().partitionId())
            forest.merge([(p, [(len(p) // ENTRY, len(c), c[0], 0, 0, 0, b",".join(b"%d" % x for x in c))]) for p, c in items])
            yield from forest.batches

    return ordered.mapInArrow(run, _SCHEMA)


def _merged_forests(contracted: DataFrame, parts: int, top: bool) -> DataFrame:
    """One forest for every ``FANOUT`` neighbouring forests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, items = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if items:
                forest = _Forest(top, False, group)
                forest.merge(items)
                yield from forest.batches

        for batch in batches:
            for now, path, hung in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if now != group:
                    yield from done()
                    group, items = now, []
                items.append((path, [tuple(h.values()) for h in hung]))
        yield from done()

    grouped = contracted.select(F.floor(F.col("part") / FANOUT).alias("group"), "part", "side", "path", "hung")
    ordered = grouped.repartition(-(-parts // FANOUT), "group").sortWithinPartitions("group", "part", "side")
    return ordered.mapInArrow(run, _SCHEMA)


def _digests(pieces: DataFrame) -> DataFrame:
    """``(ends, digest)``: digest of the pieces of a list, in order, joined by commas."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if name == now:
                    state.update(b",")
                else:
                    done += [] if state is None else [(now, state.hexdigest())]
                    now, state = name, hashlib.sha256()
                state.update(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), (pa.binary(), pa.string()))], ["ends", "digest"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["ends", "digest"])

    ordered = pieces.select("ends", "part", "path").repartition("ends").sortWithinPartitions("ends", "part")
    return ordered.mapInArrow(run, "ends binary, digest string")


def trie_of(sequences: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The nodes of ``(conv_id, path)``, a stored table; see the module."""
    size = sequences.agg(F.coalesce(F.sum(F.octet_length("path") + 16), F.lit(0))).first()[0]
    parts = max(int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    order = ["path", "conv_id"]
    ordered = sequences.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    levels = [stored(_partition_forest(ordered, parts == 1), "trie-forest")]
    while parts > 1:
        contracted = levels[-1].where(F.col("kind") == PATH)
        levels.append(stored(_merged_forests(contracted, parts, parts <= FANOUT), "trie-forest"))
        parts = -(-parts // FANOUT)
    every = reduce(DataFrame.unionByName, levels)
    named = every.where(F.col("kind") == NAMED).select("parent", F.col("conv_id").alias("low"))
    digests = stored(_digests(levels[0].where(F.col("kind") == PIECE)), "trie-digests")
    nodes = every.where(F.col("kind") == NODE).drop("kind", "part", "side", "path", "hung")
    nodes = lookup_join(lookup_join(nodes, named, ["parent"]), digests, ["ends"])
    return nodes.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "low").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", "digest").alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` of every node of the
    trie of rebuilt conversations."""
    named = stored(named_turns(conversations), "trie-turns")
    return trie_of(stored(rebuilt(paths(named)), "trie-paths"), part_bytes)
