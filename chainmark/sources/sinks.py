"""Outputs: GeoJSON layers, CSV tables with WKT, and stored measurement tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.functions import projection
from chainmark.functions.columns import join_set
from chainmark.functions.geometry import line_wkt, point, point_wkt, polygon_wkt
from chainmark.sources.database import write_layer
from chainmark.sources.layers import as_features


WKT = {"Point": point_wkt, "LineString": line_wkt, "Polygon": polygon_wkt}


def kind_of(df: DataFrame, geometry: str = "geometry") -> str:
    """Geometry kind from the column type."""
    kind = df.schema[geometry].dataType
    if isinstance(kind, T.StructType):
        return "Point"
    return "Polygon" if isinstance(kind.elementType, T.ArrayType) else "LineString"


def _moved(df: DataFrame, geometry: str, on_point, on_line) -> DataFrame:
    g, kind = F.col(geometry), kind_of(df, geometry)
    if kind == "Point":
        out = F.when(g.isNotNull(), point(*on_point(g["x"], g["y"])))
    elif kind == "LineString":
        out = on_line(g)
    else:
        out = F.transform(g, lambda ring: on_line(ring))
    return df.withColumn(geometry, out)


def to_lonlat(df: DataFrame, srid: int, geometry: str = "geometry") -> DataFrame:
    """G1: a layer in degrees."""
    return _moved(df, geometry, lambda x, y: projection.inverse(x, y, srid), lambda g: projection.inverse_line(g, srid))


def to_working(df: DataFrame, srid: int, geometry: str = "geometry") -> DataFrame:
    """G1: a lon/lat layer in working coordinates."""
    return _moved(df, geometry, lambda x, y: projection.forward(x, y, srid), lambda g: projection.forward_line(g, srid))


def flatten_sets(df: DataFrame) -> DataFrame:
    """K7: text arrays as sorted comma text."""
    sets = {f.name: join_set(F.col(f.name)) for f in df.schema
            if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)}
    return df.withColumns(sets) if sets else df


def geojson_rows(df: DataFrame, srid: int, geometry: str = "geometry") -> DataFrame:
    """K1: feature texts in degrees."""
    flat = flatten_sets(to_lonlat(df, srid, geometry))
    return as_features(flat, kind_of(df, geometry), geometry)


def write_geojson(df: DataFrame, path: str, srid: int, geometry: str = "geometry") -> None:
    """K1: newline-delimited features, written in parallel."""
    geojson_rows(df, srid, geometry).write.mode("overwrite").text(path)


def csv_rows(df: DataFrame, srid: int, geometry: str = "geometry") -> DataFrame:
    """K2: geometry as WKT in degrees (twelve decimals, far below a millimetre), sets as text."""
    flat = flatten_sets(to_lonlat(df, srid, geometry))
    return flat.withColumn(geometry, WKT[kind_of(df, geometry)](F.col(geometry), 12))


def write_csv(df: DataFrame, path: str, srid: int, geometry: str = "geometry") -> None:
    """K2."""
    csv_rows(df, srid, geometry).write.mode("overwrite").option("header", True).csv(path)


def geometry_only(df: DataFrame) -> DataFrame:
    """K3."""
    return df.select("section_id", "geometry")


def measurement_rows(df: DataFrame, srid: int) -> DataFrame:
    """K4: geometry as WKT with the code of its coordinates beside it."""
    return df.withColumn("geometry_wkb", point_wkt(F.col("geometry"))).withColumn("srid", F.lit(srid)).drop("geometry")


def write_measurements(df: DataFrame, path: str, srid: int) -> None:
    """K4: create or replace the cleaned table, one folder per line."""
    measurement_rows(df, srid).write.mode("overwrite").partitionBy("line_id").parquet(path)


def write_output(df: DataFrame, srid: int, path: str | None = None, database: Mapping[str, str] | None = None) -> None:
    """K6: a result layer to a file, to a database table, or to both."""
    if path:
        write_geojson(df, path, srid)
    if database:
        write_layer(df.withColumn("geometry", WKT[kind_of(df)](F.col("geometry"))), **database)
