"""Attribute tables and measurement tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.functions.columns import nan_to_null, union_all
from chainmark.functions.geometry import parse_wkt_line, parse_wkt_point, point, whole_point, wkt_kind


def table_key(path: str) -> str:
    """File stem, the key of an attribute table."""
    return re.sub(r"\.[^.]*$", "", path.rstrip("/").rsplit("/", 1)[-1])


def read_attribute_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One attribute table. Without a schema all columns are text until cast (no inference pass)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return nan_to_null(reader.csv(path)).withColumn("seq", F.monotonically_increasing_id())


def read_attribute_tables(spark: SparkSession, paths: Sequence[str], schemas: Mapping[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Attribute tables keyed by file stem."""
    return {table_key(p): read_attribute_table(spark, p, (schemas or {}).get(table_key(p))) for p in paths}


def read_sheet_bundles(spark: SparkSession, bundles: Sequence[Mapping[str, str]]) -> dict[str, DataFrame]:
    """Exported sheets (path to alias) of several workbooks; the same alias in two of them is united."""
    found: dict[str, list[DataFrame]] = {}
    for bundle in bundles:
        for path, alias in bundle.items():
            found.setdefault(alias, []).append(read_attribute_table(spark, path))
    return {alias: union_all(parts) for alias, parts in found.items()}


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Each table as a CSV folder named after its key."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def read_raw_measurements(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All CSV files of a folder; headers are checked against the schema."""
    return nan_to_null(
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).csv(folder))


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """A stored measurement table with its geometry column."""
    return with_geometry(spark.read.parquet(path))


def with_geometry(df: DataFrame) -> DataFrame:
    """Geometry from WKT text or from lon/lat columns; a table with neither is refused.

    A stored table keeps degrees beside its text, so the text comes first. A missing coordinate gives no geometry.
    """
    lower = {c.lower(): c for c in df.columns}
    if "geometry_wkb" in df.columns:
        return df.withColumn("geometry", whole_point(parse_wkt_point(F.col("geometry_wkb")))).drop("geometry_wkb")
    if "longitude" in lower and "latitude" in lower:
        return df.withColumn("geometry", whole_point(point(F.col(lower["longitude"]), F.col(lower["latitude"]))))
    raise ValueError("no geometry column: expected Longitude and Latitude, or geometry_wkb")


def lines_from_wkt(df: DataFrame, text: str = "wkt") -> DataFrame:
    """Vertex lists of LINESTRING texts."""
    return df.where(wkt_kind(F.col(text)) == "LINESTRING").withColumn("pts", parse_wkt_line(F.col(text))).drop(text)
