"""Cleaning of measurement and section tables, and the reports on what did not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chainmark.constants import MAIN_LINE_CODES, OTHER_LINE, REGION_LINES, SECTION_HEADERS
from chainmark.functions import projection
from chainmark.functions.columns import (
    as_double, chainage_km, clean_columns, id_part, is_clean, line_of_id, line_region, nan_to_null, rename, repair_id,
)
from chainmark.functions.geometry import point, whole_point
from chainmark.operators.intervals import section_line


def counted(df: DataFrame, name: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """Row count, and other counts, taken while the rows pass by; read it after an action."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in extra.items()]), watch


def main_lines(df: DataFrame) -> DataFrame:
    """F3."""
    return df.where(F.col("line_id") != OTHER_LINE)


def derive_ids(df: DataFrame) -> DataFrame:
    """Repaired id, chainage, line and region."""
    return (
        df.withColumn("id", repair_id(F.col("id")))
        .withColumn("chainage", chainage_km(F.col("major"), F.col("minor")))
        .withColumn("line_id", line_of_id(F.col("id"), F.col("chainage")))
        .withColumn("line_region", line_region(F.col("id")))
    )


def identified(df: DataFrame) -> DataFrame:
    """A raw measurement table with tidy columns and derived ids, all lines."""
    return derive_ids(nan_to_null(clean_columns(rename(df, {"SF": "id"}))))


def clean_measurements(df: DataFrame, srid: int | None = None) -> DataFrame:
    """A raw measurement table made ready; one with an ``id`` column only loses other lines.

    With ``srid`` a lon/lat geometry is projected, and the code is stored beside it.
    """
    if is_clean(df):
        return main_lines(df)
    tidy = identified(df)
    if srid is not None and "geometry" in tidy.columns:
        x, y = projection.forward(F.col("geometry.x"), F.col("geometry.y"), srid)
        tidy = tidy.withColumn("geometry", F.when(whole_point(F.col("geometry")).isNotNull(), point(x, y))).withColumn("srid", F.lit(srid))
    return main_lines(tidy)


def unknown_regions(df: DataFrame) -> DataFrame:
    """Regions that are not in the region table, with their number of rows."""
    region = line_region(F.col("id"))
    return (
        df.select(region.alias("line_region")).where(~F.col("line_region").isin(list(REGION_LINES)))
        .groupBy("line_region").agg(F.count(F.lit(1)).alias("rows"))
    )


def unknown_codes(df: DataFrame) -> DataFrame:
    """A10: line codes that belong to no main line."""
    return df.select(id_part(F.col("id"), 2).alias("code")).where(~F.col("code").isin(list(MAIN_LINE_CODES))).distinct()


def unmatched(points: DataFrame, key: str = "section_id") -> DataFrame:
    """Rows that found no partner."""
    return points.where(F.col(key).isNull())


def prepare_sections(table: DataFrame, skip_first_row: bool = False) -> DataFrame:
    """Curve and tangent rows with numeric ends and the line of their start.

    ``skip_first_row`` drops the row numbered 0 by ``seq``; header-like rows, rows without length and rows
    that start at or below zero are left out.
    """
    tidy = rename(clean_columns(table), {"asset_name": "section_id", "id": "section_id"})
    if skip_first_row:
        tidy = tidy.where(F.col("seq") != 0)
    tidy = tidy.where(~F.coalesce(F.col("section").isin(SECTION_HEADERS), F.lit(False)))
    tidy = (
        tidy.withColumn("start_km", as_double(F.col("start_chainage_km")))
        .withColumn("end_km", as_double(F.col("end_chainage_km")))
        .drop("start_chainage_km", "end_chainage_km")
    )
    tidy = tidy.where((F.col("start_km") != F.col("end_km")) & (F.col("start_km") > 0))
    return tidy.withColumn("line_id", section_line(F.col("section"), F.col("start_km")))


def zero_length(table: DataFrame) -> DataFrame:
    """sections left out because both ends are the same."""
    tidy = rename(clean_columns(table), {"asset_name": "section_id", "id": "section_id"})
    return tidy.where(as_double(F.col("start_chainage_km")) == as_double(F.col("end_chainage_km")))
