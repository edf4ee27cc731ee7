"""Segments with attributes and switches, and sections with shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainmark.functions import projection
from chainmark.functions.columns import attribute_key, clean_columns, drop_excluded
from chainmark.functions.geometry import line_centroid
from chainmark.operators.intervals import find_segments, section_line
from chainmark.operators.linear import interpolate, substring
from chainmark.operators.scale import lookup_join, shuffled
from chainmark.operators.spatial import locate
from chainmark.session import checkpointed


def _attributes(track: DataFrame) -> DataFrame:
    tidy = clean_columns(drop_excluded(track)).withColumnRenamed("chainage_id", "attribute_key")
    return tidy.withColumnsRenamed({"chainage_start_km": "table_start_km", "chainage_end_km": "table_end_km"})


def with_attributes(segments: DataFrame, track: DataFrame) -> DataFrame:
    """Attribute row of each segment by its text key; TLX segments are listed under MLX."""
    keyed = segments.withColumn("attribute_key", attribute_key(F.col("chainage_id")))
    joined = lookup_join(keyed, _attributes(track).withColumn("has_attributes", F.lit(True)), ["attribute_key"])
    return joined.withColumn("has_attributes", F.coalesce("has_attributes", F.lit(False))).drop("attribute_key")


def missing_attributes(segments: DataFrame, track: DataFrame) -> DataFrame:
    """Segments without an attribute row."""
    return with_attributes(segments, track).where(~F.col("has_attributes")).select("line_id", "chainage_id")


def _agrees(table_km: str, own_km: str):
    return F.round(F.col(table_km) * 10) == F.round(F.col(own_km) * 10)


def mismatched_attributes(joined: DataFrame) -> DataFrame:
    """segments whose attribute row gives other kilometres, to one decimal, at either end."""
    return joined.where(F.col("has_attributes") & ~(
        _agrees("table_start_km", "chainage_start_km") & _agrees("table_end_km", "chainage_end_km")))


def checked_attributes(joined: DataFrame, strict: bool = False) -> DataFrame:
    """all segments, with ``attributes_agree``; ``strict`` fails on the first whose row is missing or disagrees."""
    good = F.col("has_attributes") & _agrees("table_start_km", "chainage_start_km") & _agrees("table_end_km", "chainage_end_km")
    if not strict:
        return joined.withColumn("attributes_agree", F.coalesce(good, F.lit(False)))
    failed = F.concat(F.lit("attributes missing or other kilometres at "), F.col("chainage_id"))
    return joined.withColumn("attributes_agree", F.when(good, True).otherwise(F.raise_error(failed).cast("boolean")))


def with_centroid(rows: DataFrame, srid: int, geometry: str = "geometry") -> DataFrame:
    """Centre of each shape in working coordinates and in degrees."""
    rows = rows.withColumn("_c", line_centroid(F.col(geometry)))
    lng, lat = projection.inverse(F.col("_c.x"), F.col("_c.y"), srid)
    return rows.withColumns({
        "mid_coord_E": F.col("_c.x"), "mid_coord_N": F.col("_c.y"), "mid_coord_lng": lng, "mid_coord_lat": lat,
    }).drop("_c")


def section_ends(sections: DataFrame, segments: DataFrame) -> DataFrame:
    """J2 on both ends: segment and measure along its line, for ``end`` 0 (start) and 1 (end)."""
    both = sections.select(
        "section_id", F.col("line_id").alias("own_line_id"), "section",
        F.explode(F.array(
            F.struct(F.lit(0).alias("end"), F.col("start_km").alias("chainage")),
            F.struct(F.lit(1).alias("end"), F.col("end_km").alias("chainage")))).alias("e"),
    ).select("section_id", "own_line_id", "section", "e.*")
    both = both.withColumn("line_id", section_line(F.col("section"), F.col("chainage")))
    named = segments.select("line_id", "chainage_id", "chainage_start_km", "chainage_end_km",
                            "m_start", "m_end", F.col("chainage_start_km").alias("_base_km"))
    found = find_segments(both, named, carry=["m_start", "m_end", "_base_km"])
    measure = F.least(F.col("m_start") + (F.col("chainage") - F.col("_base_km")) * 1000.0, F.col("m_end"))
    return found.withColumn("measure", measure).drop("m_start", "m_end", "_base_km")


def build_sections(sections: DataFrame, segments: DataFrame, edges: DataFrame, srid: int | None = None) -> DataFrame:
    """Shape and centre of each section along the line of its start.

    An end on the same line is a measure already. An end on another line is placed there and projected onto
    the section's own line. A section with an end in no segment gets a null shape (see ``lost_ends``).
    """
    ends = checkpointed(section_ends(sections, segments))
    away = ends.where(F.col("measure").isNotNull() & (F.col("line_id") != F.col("own_line_id")))
    home = ends.where(F.col("measure").isNull() | (F.col("line_id") == F.col("own_line_id"))).select("section_id", "end", "measure")
    if away.limit(1).count():
        placed = interpolate(away.select("section_id", "end", "line_id", "own_line_id", "measure"), edges)
        placed = placed.drop("line_id", "measure").withColumnRenamed("own_line_id", "line_id")
        near = locate(placed, edges, by=("line_id",))
        home = home.unionByName(near.select("section_id", "end", F.col("near.measure").alias("measure")))
    measures = home.groupBy("section_id").agg(
        F.max(F.when(F.col("end") == 0, F.col("measure"))).alias("a"),
        F.max(F.when(F.col("end") == 1, F.col("measure"))).alias("b"))
    placed = checkpointed(sections.join(shuffled(measures), "section_id"))
    shapes = substring(placed.where("a is not null and b is not null").select("line_id", "section_id", "a", "b"), edges, key="section_id")
    out = placed.join(shuffled(shapes.select("section_id", F.col("pts").alias("geometry"))), "section_id", "left")
    return with_centroid(out, srid) if srid is not None else out


def lost_ends(sections: DataFrame, segments: DataFrame) -> DataFrame:
    """Section ends that lie in no segment."""
    return section_ends(sections, segments).where(F.col("chainage_id").isNull()).select(
        "section_id", "end", "line_id", "chainage")
