"""Points to intervals per line: which section or segment holds a chainage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainmark.constants import LINE_START_KM, TLX_END_KM
from chainmark.operators.scale import BROADCAST_BYTES, HOT_ROWS, _join, lookup_join, row_bytes, shuffled

CROWDED = 64


def first_start_wins(intervals: DataFrame, line: str, start: str, end: str, ident: str, block: float = 1024.0) -> DataFrame:
    """O3: cut overlapping intervals into disjoint ones, the earliest (start, id) winning everywhere.

    All intervals before one in this order start no later, so what is left of it is the part beyond the
    largest end so far: a running maximum. It is taken in blocks of the line, so that a long line is not
    one task. ``_open`` tells that the left end belongs to the interval before.
    """
    order = [start, ident]
    blocked = intervals.withColumn("_block", F.floor(F.col(start) / F.lit(block)))
    earlier = Window.partitionBy(line).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    reach = blocked.groupBy(line, "_block").agg(F.max(end).alias("_reach")).select(
        line, "_block", F.max("_reach").over(earlier).alias("_reach"))
    inside = Window.partitionBy(line, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.withColumn("_inside", F.max(end).over(inside))
        .join(shuffled(reach), [line, "_block"])
        .withColumn("_seen", F.greatest("_inside", "_reach"))
        .withColumn("_open", F.coalesce(F.col("_seen") >= F.col(start), F.lit(False)))
        .withColumn("_lo", F.when(F.col("_open"), F.col("_seen")).otherwise(F.col(start)))
        .withColumn("_hi", F.col(end))
        .drop("_block", "_inside", "_reach", "_seen")
    )


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    ident: str = "section_id",
    line: str = "line_id",
    at: str = "chainage",
    start: str = "start_km",
    end: str = "end_km",
    carry: Sequence[str] = (),
    closed: bool = False,
    width: float | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of each point to the interval that holds it; at most one row per point.

    Half-open ``start <= at < end`` by default, ``closed`` takes in the end. Where intervals overlap the
    first by (start, id) is taken. Intervals are made disjoint and cut into bins, so that the join has an
    equality on (line, bin) and unmatched points stay without a second join. Bins crowded with short
    intervals are cut finer. Reversed and empty intervals hold nothing.
    """
    kept = [ident, *carry]
    clean = intervals.select(line, start, end, *kept).where(
        F.col(line).isNotNull() & (F.col(start) <= F.col(end) if closed else F.col(start) < F.col(end)))
    shape = clean.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(end) - F.col(start)).alias("mean"),
        F.sum(F.col(end) - F.col(start)).alias("total"),
        F.coalesce(F.max(row_bytes(clean)), F.lit(0)).alias("widest"),
    ).first()
    if width is None:
        width = max(shape["mean"] or 1.0, 1e-6)

    def scaled(col: Column) -> Column:
        return col / F.lit(width)

    # Disjoint parts keep the end of the interval they come from, so a bin meets at most (ends in it) + 1 parts,
    # and there are at most total / width + 2n rows after binning: both bounds come from the plain intervals.
    rows = int((shape["total"] or 0.0) / width) + 2 * shape["n"]
    most = 0
    if shape["n"] > CROWDED:
        most = clean.groupBy(line, F.floor(scaled(F.col(end))).alias("_bin")).count().agg(F.max("count").alias("m")).first()["m"]

    parts = first_start_wins(clean, line, start, end, ident, width * 1024)
    parts = parts.where((F.col("_lo") < F.col("_hi")) | (F.lit(closed) & ~F.col("_open") & (F.col("_lo") == F.col("_hi"))))
    parts = parts.select(line, "_lo", "_hi", "_open", *kept)
    binned = parts.withColumn("_bin", F.explode(F.sequence(F.floor(scaled(F.col("_lo"))), F.floor(scaled(F.col("_hi"))))))
    points = points.withColumn("_bin", F.floor(scaled(F.col(at))))
    keys = [line, "_bin"]
    if most >= CROWDED:
        crowded = (
            binned.groupBy(line, "_bin").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CROWDED)
            .select(line, "_bin", F.ceil(F.col("_n") / F.lit(8)).cast("long").alias("_ways"))
        )

        def sub(col: Column) -> Column:
            cell = F.floor((scaled(col) - F.col("_bin")) * F.col("_ways"))
            return F.coalesce(F.least(F.greatest(cell, F.lit(0)), F.col("_ways") - 1), F.lit(0).cast("long"))

        points = lookup_join(points, crowded, keys, limit_bytes=limit_bytes, hot_rows=hot_rows)
        points = points.withColumn("_sub", sub(F.col(at))).drop("_ways")
        binned = _join(binned, F.broadcast(crowded) if rows * 48 <= limit_bytes else shuffled(crowded), keys, None, "left")
        binned = binned.withColumn("_sub", F.explode(F.sequence(sub(F.col("_lo")), sub(F.col("_hi"))))).drop("_ways")
        keys, rows = keys + ["_sub"], 2 * rows
    right = F.col(at) <= F.col("_hi") if closed else F.col(at) < F.col("_hi")
    left = (F.col(at) > F.col("_lo")) | ((F.col(at) == F.col("_lo")) & ~F.col("_open")) if closed else F.col(at) >= F.col("_lo")
    joined = lookup_join(points, binned, keys, left & right, "left", limit_bytes, hot_rows, rows * (48 + shape["widest"]))
    return joined.drop("_bin", "_sub", "_lo", "_hi", "_open")


def assign_sections(points: DataFrame, sections: DataFrame, **options) -> DataFrame:
    """Section of each measurement by recorded chainage."""
    return interval_join(points, sections, ident="section_id", **options)


def snapped_chainage(line: Column, metres: Column) -> Column:
    """Chainage from the distance along the line; null for a line without a start value."""
    start = F.lit(None).cast("double")
    for name, km in LINE_START_KM.items():
        start = F.when(line == name, km).otherwise(start)
    return start + metres / F.lit(1000.0)


def assign_sections_by_distance(points: DataFrame, sections: DataFrame, metres: str = "len_from_line_start", **options) -> DataFrame:
    """Section of each measurement by its snapped distance along the line."""
    return interval_join(
        points.withColumn("_at", snapped_chainage(F.col("line_id"), F.col(metres))), sections,
        ident="section_id", at="_at", **options,
    ).drop("_at")


def section_line(code: Column, chainage: Column) -> Column:
    """Line of a section end, from its section code and chainage."""
    return (
        F.when(code == "SL", "SML").when(code == "EL", "EML")
        .when(chainage <= TLX_END_KM, "TLX").otherwise("MLX")
    )


def find_segments(ends: DataFrame, segments: DataFrame, at: str = "chainage", carry: Sequence[str] = (), **options) -> DataFrame:
    """Segment holding a chainage, both ends of the segment included, the first one winning."""
    return interval_join(
        ends, segments, ident="chainage_id", at=at, start="chainage_start_km", end="chainage_end_km",
        carry=carry, closed=True, **options,
    )


def reversed_sections(sections: DataFrame, start: str = "start_km", end: str = "end_km") -> DataFrame:
    """Sections whose start lies beyond their end; they hold no points and are reported."""
    return sections.where(F.col(start) > F.col(end))


def interval_summary(sections: DataFrame) -> DataFrame:
    """Per line the number of intervals and the first and last one in table order."""
    return sections.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("num_intervals"),
        F.min_by("section_id", "seq").alias("first_section"),
        F.max_by("section_id", "seq").alias("last_section"),
        F.min_by("start_km", "seq").alias("first_start_km"),
        F.max_by("end_km", "seq").alias("last_end_km"),
    )
