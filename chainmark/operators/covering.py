"""Union of lines that overlap: how many edges cover each stretch, and the stretches that any edge covers, each once.

Edges lie on carriers: straight lines named by their primitive direction (x to the right, or straight up) and offset, both
whole numbers on the grid of ``noding``, so edges share a carrier exactly or not at all. Along a carrier each edge adds one
at its start and takes one away at its end; these changes are summed at equal places before they are numbered over range
partitions, and the count before each place is a blocked running sum. No task holds a carrier, and no edges are paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.operators.noding import on_grid
from chainmark.operators.scale import lookup_join, numbered, running_sum
from chainmark.session import checkpointed

_CARRIER = ["ux", "uy", "off"]
#: Steps of Euclid's algorithm that numbers below 2 ** 54 take at most.
_STEPS = 80


def _gcd(a: Column, b: Column) -> Column:
    start = F.struct(F.abs(a).alias("a"), F.abs(b).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), start, lambda s, _: F.when(s["b"] == 0, s).otherwise(
        F.struct(s["b"].alias("a"), (s["a"] % F.when(s["b"] == 0, 1).otherwise(s["b"])).alias("b"))), lambda s: s["a"])


def _wide(v: str) -> Column:
    return F.col(v).cast("decimal(18,0)")


def _changes(edges: DataFrame, digits: int) -> DataFrame:
    """``(ux, uy, off, s, delta, before, n)``: places along carriers where the number of covering edges changes, in order."""
    grid = on_grid(edges, digits).select("ax", "ay", (F.col("bx") - F.col("ax")).alias("dx"), (F.col("by") - F.col("ay")).alias("dy"))
    ahead = (F.col("dx") > 0) | ((F.col("dx") == 0) & (F.col("dy") > 0))
    part = _gcd(F.col("dx"), F.col("dy"))
    turned = grid.withColumn("g", F.when(ahead, part).otherwise(-part))
    on = turned.select("ax", "ay", "dx", "dy", F.expr("dx div g").alias("ux"), F.expr("dy div g").alias("uy"))
    on = on.withColumn("off", (_wide("ux") * _wide("ay") - _wide("uy") * _wide("ax")).cast("decimal(38,0)"))
    place = F.when(F.col("ux") > 0, F.col("ax")).otherwise(F.col("ay"))
    other = place + F.when(F.col("ux") > 0, F.col("dx")).otherwise(F.col("dy"))
    ends = F.array(F.struct(F.least(place, other).alias("s"), F.lit(1).alias("delta")), F.struct(F.greatest(place, other).alias("s"), F.lit(-1).alias("delta")))
    events = on.select(*_CARRIER, F.explode(ends).alias("e")).groupBy(*_CARRIER, F.col("e.s").alias("s")).agg(F.sum("e.delta").alias("delta"))
    # Where as many edges end as begin the count stays, but the place still parts two stretches of the count.
    ordered = checkpointed(numbered(events, [*_CARRIER, "s"], "n"))
    heads = ordered.groupBy(*_CARRIER).agg(F.min("n").alias("_first"))
    dense = lookup_join(ordered, heads, _CARRIER, how="inner").withColumn("_seq", F.col("n") - F.col("_first")).drop("_first")
    return running_sum(dense, _CARRIER, "_seq", "delta", "before").drop("_seq")


def _between(rows: DataFrame, number: str, digits: int, *more: Column) -> DataFrame:
    """Stretches from each row to the one with the next number, as positions."""
    after = rows.select((F.col(number) - 1).alias(number), F.col("s").alias("to"))
    both = rows.join(after, number)
    unit = F.lit(float(10 ** digits))

    def at(s: str) -> tuple[Column, Column]:
        upright = F.col("ux") == 0
        x = F.when(upright, F.expr("cast(-off as bigint)")).otherwise(F.col(s))
        y = F.when(upright, F.col(s)).otherwise(F.expr(f"(off + cast(uy as decimal(18,0)) * cast({s} as decimal(18,0))) div case when ux = 0 then 1 else ux end"))
        return x / unit, y / unit

    (x1, y1), (x2, y2) = at("s"), at("to")
    return both.select(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), *more)


def cover_counts(edges: DataFrame, digits: int = 6) -> DataFrame:
    """``(x1, y1, x2, y2, covers)``: stretches between neighbouring ends on a carrier, with the number of edges over each."""
    rows = checkpointed(_changes(edges, digits))
    covers = (F.col("before") + F.col("delta")).cast("long")
    return _between(rows, "n", digits, covers.alias("covers")).where("covers > 0")


def union_lines(edges: DataFrame, digits: int = 6) -> DataFrame:
    """``(x1, y1, x2, y2)``: the longest straight stretches that edges cover, overlaps and edges end to end taken together.

    Stretches run to the right, or straight up. Edges are compared on the grid; those without length there are left out.
    """
    rows = _changes(edges, digits)
    bounds = rows.where((F.col("before") == 0) | (F.col("before") + F.col("delta") == 0))
    bounds = checkpointed(numbered(bounds, [*_CARRIER, "s"], "k"))
    return _between(bounds, "k", digits, F.col("before").alias("before")).where("before = 0").drop("before")
