"""Lines put together from parts that meet end to end, by distributed list ranking.

Two ends are joined where exactly two meet; at a place with more ends, or with one, lines end. A part can be walked in two
directions, so each has two states; the state a walk comes to next is its successor. Pointer doubling finds for every state
where its walk ends and how many parts away that is: each round joins the states still under way to all states and doubles
the distance looked ahead, so a chain of n parts takes about log2(n) rounds, each written to the shared folder.

A merged line runs in the direction of its smallest part. A ring has no end; it is cut where its smallest part starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainmark.operators.scale import lookup_join
from chainmark.session import checkpointed

_STATE = ["id", "back"]


def _successors(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(id, back, to, to_back)``: what each state comes to next, null at an end; ``back`` is true against the vertex order."""
    first, last = F.get("pts", F.lit(0)), F.get("pts", F.size("pts") - 1)
    end = [F.struct(F.lit(far).alias("far"), p["x"].alias("x"), p["y"].alias("y")) for far, p in ((False, first), (True, last))]
    ends = parts.select("id", *keys, F.explode(F.array(*end)).alias("e")).select("id", *keys, "e.*")
    one = F.struct("id", "far")
    # Two ends at most are kept of any place, however many meet there.
    meet = ends.groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("p"), F.max(one).alias("q")).where("n = 2")
    both = F.explode(F.array(F.struct(F.col("p").alias("p"), F.col("q").alias("q")), F.struct(F.col("q").alias("p"), F.col("p").alias("q"))))
    links = meet.select(both.alias("l")).select(F.col("l.p.id").alias("id"), (~F.col("l.p.far")).alias("back"), F.col("l.q.id").alias("to"), F.col("l.q.far").alias("to_back"))
    states = parts.select("id", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    return states.join(links, _STATE, "left")


def _walked(successors: DataFrame) -> DataFrame:
    """``(id, back, to, to_back, n, low, done)``: the last state of each walk, the parts up to it and the smallest of them.

    Walks round a ring never end; theirs are not ``done``, and ``low`` is the smallest part of the ring.
    """
    ends = F.col("to").isNull()
    now = checkpointed(successors.select(
        *_STATE, F.coalesce("to", "id").alias("to"), F.coalesce("to_back", "back").alias("to_back"), F.when(ends, 0).otherwise(1).cast("long").alias("n"),
        F.least("id", F.coalesce("to", "id")).alias("low"), ends.alias("done"), F.lit(True).alias("moved")))
    while True:
        ahead = now.select(F.col("id").alias("to"), F.col("back").alias("to_back"), F.col("to").alias("on"), F.col("to_back").alias("on_back"),
                           F.col("n").alias("more"), F.col("low").alias("below"), F.col("done").alias("over"))
        going = now.where("not done").join(ahead, ["to", "to_back"])
        going = going.select(*_STATE, F.col("on").alias("to"), F.col("on_back").alias("to_back"), (F.col("n") + F.col("more")).alias("n"),
                             F.least("low", "below").alias("low"), F.col("over").alias("done"), (F.col("over") | (F.col("below") < F.col("low"))).alias("moved"))
        now = checkpointed(now.where("done").withColumn("moved", F.lit(False)).unionByName(going))
        # A round that ends no walk and lowers no smallest part has looked all the way round every ring.
        if now.where("moved").limit(1).count() == 0:
            return now.drop("moved")


def merged_order(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(id, chain, place, back)`` of each part: its merged line, named by its smallest part, its place there from 0, and
    whether it is turned round.

    ``parts`` has a distinct ``id`` of any orderable type and a vertex list ``pts``; parts only join where ``keys`` are equal.
    Parts without vertices are left out.
    """
    parts = parts.where(F.size("pts") > 0)
    successors = checkpointed(_successors(parts, keys))
    walked = _walked(successors)
    rings = walked.where("not done").select(*_STATE, "low")
    if rings.limit(1).count():
        entry = (F.col("to") == F.col("low")) & ~F.col("to_back")
        exit_ = (F.col("id") == F.col("low")) & F.col("back")
        cut = successors.join(rings, _STATE)
        nothing = cut.withColumns({c: F.when(~(entry | exit_), F.col(c)) for c in ("to", "to_back")}).drop("low")
        walked = walked.where("done").unionByName(_walked(nothing))
    walked = checkpointed(walked)
    chains = walked.groupBy("id").agg(F.min("low").alias("chain"))
    named = checkpointed(walked.join(chains, "id"))
    # The walk of the smallest part in its own direction ends where all walks of the chosen direction end.
    heads = named.where((F.col("id") == F.col("chain")) & ~F.col("back")).select("chain", F.col("to").alias("end"), F.col("to_back").alias("end_back"))
    chosen = lookup_join(named, heads, ["chain"], (F.col("to") == F.col("end")) & (F.col("to_back") == F.col("end_back")), "inner")
    chosen = chosen.select("id", "back", "chain", "n")
    longest = chosen.groupBy("chain").agg(F.max("n").alias("most"))
    return lookup_join(chosen, longest, ["chain"], how="inner").select("id", "chain", (F.col("most") - F.col("n")).alias("place"), "back")


def merge_lines(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, chain, parts, pts)``: each merged line once, shared vertices once; see ``merged_order``."""
    order = merged_order(parts, keys)
    placed = parts.select("id", *keys, "pts").join(order, "id")
    turned = F.when(F.col("back"), F.reverse("pts")).otherwise(F.col("pts"))
    listed = placed.groupBy(*keys, "chain").agg(F.array_sort(F.collect_list(F.struct("place", turned.alias("pts")))).alias("p"))
    tail = F.transform("p", lambda part, i: F.when(i == 0, part["pts"]).otherwise(F.slice(part["pts"], F.lit(2), F.greatest(F.size(part["pts"]) - 1, F.lit(0)))))
    return listed.select(*keys, "chain", F.size("p").cast("long").alias("parts"), F.flatten(tail).alias("pts"))
