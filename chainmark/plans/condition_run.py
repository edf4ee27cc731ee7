"""The whole condition run: layers and tables in, segments, switches and section condition out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainmark.constants import LINE_CHAINAGES, LINES
from chainmark.functions.geometry import join_pieces
from chainmark.operators import cleaning, intervals, linear, sections, spatial, stats
from chainmark.operators.merging import merge_lines
from chainmark.operators.scale import numbered
from chainmark.session import checkpointed
from chainmark.sources import layers, sinks


@dataclass
class Condition:
    """Results of a run. Only the point tables are lazy; segments and sections are written once, when the run is built.

    ``reports`` has what the run left aside, by name: ``wrong_attributes``, ``lost_ends``, ``reversed_sections``,
    ``zero_length_sections``, ``unclassified``, ``unknown_regions``, ``unknown_codes`` and ``unmatched`` points.
    """

    lines: DataFrame
    segments: DataFrame
    switches: DataFrame
    sections: DataFrame
    rp_points: DataFrame
    tg_points: DataFrame
    rp_sections: DataFrame
    tg_sections: DataFrame
    poi: DataFrame
    reports: dict[str, DataFrame]


def four_lines(centreline: DataFrame, poi: DataFrame) -> DataFrame:
    """The network as one vertex list per line.

    The main line is cut at its position nearest to the point ``mainline_start``, each time it passes there. What
    lies before the first cut is TLX; the pieces after it make MLX, joined end to end where there are several.
    Features of one line are merged where they meet end to end, in the direction of the one that sorts first; a line
    that is still several pieces, or has a feature twice, is refused.
    """
    named = layers.split_layers(centreline.withColumnRenamed("geometry", "pts")).select("line_id", "pts")
    if linear.duplicate_lines(named).limit(1).count():
        parts = checkpointed(numbered(named, ["line_id", "pts"], "id"))
        twice = parts.groupBy("line_id", "pts").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        named = checkpointed(merge_lines(parts, ["line_id"]).unionByName(twice, allowMissingColumns=True).select("line_id", "pts"))
    if several := linear.duplicate_lines(named).limit(10).collect():
        raise ValueError(f"lines of several pieces: {sorted(r['line_id'] for r in several)}")
    others = named.where(F.col("line_id") != "MLX")
    main = checkpointed(linear.edge_table(named.where(F.col("line_id") == "MLX")))
    start = spatial.snap(poi.where(F.col("name") == "mainline_start"), main)
    cuts = linear.passes(main, start.select(F.lit("MLX").alias("line_id"), F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y")))
    pieces = linear.cut_lines(main, cuts).select("piece", "pts")
    first = pieces.where("piece = 0").select(F.lit("TLX").alias("line_id"), "pts")
    rest = pieces.where("piece > 0").groupBy().agg(F.array_sort(F.collect_list(F.struct("piece", "pts"))).alias("parts"))
    joined = F.when(F.size("parts") > 1, join_pieces(F.transform("parts", lambda p: p["pts"]))).otherwise(F.get("parts", F.lit(0))["pts"])
    return first.unionByName(rest.select(F.lit("MLX").alias("line_id"), joined.alias("pts"))).unionByName(others)


def run(
    centreline: DataFrame, switch_points: DataFrame, attributes: DataFrame, curves: DataFrame,
    rp: DataFrame, tg: DataFrame, srid: int = 28350, poi: DataFrame | None = None, lines: DataFrame | None = None,
    chainages: Mapping[str, Mapping] = LINE_CHAINAGES, strict: bool = False, snapped: bool = False,
) -> Condition:
    """All stages as one plan; only lines, segments and sections, all small, are written in between.

    ``centreline`` has Layer and geometry, ``switch_points`` the surveyed list or id and geometry, ``attributes`` the rows of all
    segment tables, ``curves`` the curve and tangent table, and ``rp``/``tg`` raw or cleaned measurements. All
    geometry is in working coordinates except that of raw measurements, which is in degrees.

    Segments whose attribute row is missing or disagrees stay, marked and reported; ``strict`` fails instead. With
    ``snapped`` points are moved onto their line and take the section at their distance along it, not at their
    surveyed kilometre.
    """
    spark = centreline.sparkSession
    poi = layers.poi(spark) if poi is None else poi
    lines = checkpointed(four_lines(centreline, poi) if lines is None else lines)
    edges = checkpointed(linear.edge_table(lines))
    segments = linear.chainage_segments(edges, chainages)
    segments = sections.checked_attributes(sections.with_attributes(segments, attributes), strict)
    segments = checkpointed(sections.with_centroid(segments, srid))
    if "Name" in switch_points.columns:
        switch_points = spatial.switch_rows(switch_points)
    switches = spatial.nearest_segment(switch_points, segments, LINES)
    switches = checkpointed(switches)
    wrong = segments.where(~F.col("attributes_agree")).select("line_id", "chainage_id", "has_attributes")
    segments = checkpointed(spatial.switch_ids(segments, switches))

    # A table read from a file numbers its rows; the one numbered 0 repeats the header and is left out.
    numbered = "seq" in curves.columns
    curves = curves if numbered else curves.withColumn("seq", F.monotonically_increasing_id())
    curve_table = cleaning.prepare_sections(curves, skip_first_row=numbered)
    curve_rows = checkpointed(sections.build_sections(curve_table, segments, edges, srid))

    def placed(points: DataFrame) -> DataFrame:
        clean = cleaning.clean_measurements(points, srid)
        if not snapped:
            return intervals.assign_sections(clean, curve_rows)
        moved = spatial.snap(clean, edges).withColumn("line_id", F.coalesce("snapped_line_id", "line_id")).drop("snapped_line_id")
        return intervals.assign_sections_by_distance(moved, curve_rows)

    rp_points, tg_points = placed(rp), placed(tg)
    tg_sections = checkpointed(stats.with_section(stats.tg_stats(tg_points), curve_rows))
    rp_sections = stats.with_section(stats.rp_stats(rp_points), curve_rows)
    rp_sections = checkpointed(stats.with_speeds(stats.with_status(rp_sections), tg_sections))
    reports = {
        "wrong_attributes": wrong,
        "lost_ends": sections.lost_ends(curve_table, segments),
        "reversed_sections": intervals.reversed_sections(curve_rows).select("section_id", "line_id"),
        "zero_length_sections": cleaning.zero_length(curves).select("section_id"),
        "unclassified": stats.unclassified(curve_rows).select("section_id", "line_id"),
        "unmatched": rp_points.where("section_id is null").groupBy("line_id").agg(F.count(F.lit(1)).alias("points")),
    }
    if not cleaning.is_clean(rp):
        raw = cleaning.identified(rp)
        reports |= {"unknown_regions": cleaning.unknown_regions(raw), "unknown_codes": cleaning.unknown_codes(raw)}
    return Condition(lines, segments, switches, curve_rows, rp_points, tg_points, rp_sections, tg_sections, checkpointed(spatial.snap(poi, edges)), reports)


def write_cleaned(result: Condition, folder: str, srid: int = 28350) -> None:
    """K4: the cleaned measurement tables, so that later runs start from them."""
    sinks.write_measurements(result.rp_points.drop("section_id"), f"{folder}/rp_data", srid)
    sinks.write_measurements(result.tg_points.drop("section_id"), f"{folder}/tg_data", srid)


def write_outputs(result: Condition, folder: str, srid: int = 28350) -> None:
    """K1-K3: segment layers per line, points of interest, switches, and section layers with their tables."""
    for line in LINES:
        sinks.write_geojson(result.segments.where(F.col("line_id") == line), f"{folder}/{line.lower()}_segments.geojson", srid)
    sinks.write_geojson(result.poi, f"{folder}/pois.geojson", srid)
    sinks.write_geojson(result.switches, f"{folder}/switches.geojson", srid)
    for name, table in (("rp_sections", result.rp_sections), ("tg_sections", result.tg_sections)):
        sinks.write_geojson(table, f"{folder}/{name}.geojson", srid)
        sinks.write_csv(table, f"{folder}/{name}.csv", srid)
        sinks.write_geojson(sinks.geometry_only(table), f"{folder}/{name}_geoms.geojson", srid)
