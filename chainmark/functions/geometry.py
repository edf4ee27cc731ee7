"""Geometry as structs and arrays: measures, text forms and parsing, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def whole_point(p: Column) -> Column:
    """A position with both coordinates; null where one is missing or not a number."""
    return F.when(p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]), p)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """G15."""
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def snap_grid(pts: Column, digits: int = 8) -> Column:
    """S3: coordinates on a 1e-8 grid."""
    return F.transform(pts, lambda p: F.struct(F.round(p["x"], digits).alias("x"), F.round(p["y"], digits).alias("y")))


def _legs(pts: Column) -> Column:
    """Pairs of neighbouring vertices with their distance."""
    count = F.size(pts)
    heads = F.slice(pts, F.lit(1), F.greatest(count - 1, F.lit(0)))
    tails = F.slice(pts, F.lit(2), F.greatest(count - 1, F.lit(0)))
    return F.zip_with(heads, tails, lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"),
        distance(a["x"], a["y"], b["x"], b["y"]).alias("d"),
    ))


def line_length(pts: Column) -> Column:
    """G4."""
    return F.aggregate(_legs(pts), F.lit(0.0), lambda acc, s: acc + s["d"])


def line_centroid(pts: Column) -> Column:
    """Centre of a line weighted by length; a line without length gives its first vertex."""
    zero = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    first = F.get(pts, F.lit(0))
    return F.aggregate(
        _legs(pts), zero,
        lambda acc, s: F.struct(
            (acc["d"] + s["d"]).alias("d"),
            (acc["x"] + s["d"] * (s["x1"] + s["x2"]) / F.lit(2.0)).alias("x"),
            (acc["y"] + s["d"] * (s["y1"] + s["y2"]) / F.lit(2.0)).alias("y"),
        ),
        lambda acc: F.when(acc["d"] > 0, point(acc["x"] / acc["d"], acc["y"] / acc["d"])).otherwise(first),
    )


def join_loop(a: Column, b: Column) -> Column:
    """Two pieces end to end, each without its last vertex."""
    return F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.slice(b, F.lit(1), F.size(b) - 1))


def join_pieces(pieces: Column) -> Column:
    """G12 for any number of pieces: end to end, each without its last vertex."""
    return F.flatten(F.transform(pieces, lambda p: F.slice(p, F.lit(1), F.size(p) - 1)))


def number_text(col: Column, digits: int = 6) -> Column:
    """A coordinate with at most ``digits`` decimals and no trailing zeros."""
    text = F.regexp_replace(F.format_string(f"%.{digits}f", col), r"\.?0+$", "")
    return F.when(text == "-0", "0").otherwise(text)


def _pair_text(p: Column, digits: int) -> Column:
    return F.concat_ws(" ", number_text(p["x"], digits), number_text(p["y"], digits))


def point_wkt(p: Column, digits: int = 6) -> Column:
    """K2/K4."""
    return F.when(whole_point(p).isNotNull(), F.concat(F.lit("POINT ("), _pair_text(p, digits), F.lit(")")))


def line_wkt(pts: Column, digits: int = 6) -> Column:
    """K2/K4."""
    pairs = F.array_join(F.transform(pts, lambda p: _pair_text(p, digits)), ", ")
    return F.when(pts.isNotNull(), F.concat(F.lit("LINESTRING ("), pairs, F.lit(")")))


def polygon_wkt(rings: Column, digits: int = 6) -> Column:
    """K2/K6."""
    def ring(pts):
        return F.concat(F.lit("("), F.array_join(F.transform(pts, lambda p: _pair_text(p, digits)), ", "), F.lit(")"))
    return F.when(rings.isNotNull(), F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, ring), ", "), F.lit(")")))


def _pairs(text: Column) -> Column:
    def one(pair):
        parts = F.split(F.trim(pair), r"\s+")
        return point(F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double"))
    return F.transform(F.split(text, ","), one)


def wkt_kind(text: Column) -> Column:
    return F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))


def parse_wkt_line(text: Column) -> Column:
    """Vertices of a POINT or LINESTRING; further ordinates are left out."""
    inner = F.regexp_extract(text, r"\(([^()]*)\)", 1)
    return F.when(inner != "", _pairs(inner))


def parse_wkt_point(text: Column) -> Column:
    """S9."""
    return F.get(parse_wkt_line(text), F.lit(0))


def parse_wkt_polygon(text: Column) -> Column:
    """Rings of a POLYGON."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1)), _pairs)


def _coords(p: Column) -> Column:
    return F.array(p["x"], p["y"])


def feature_json(kind: str, geometry: Column, properties: Column) -> Column:
    """K1: one GeoJSON feature as text; ``geometry`` is a point, a vertex list or a ring list."""
    if kind == "Point":
        geometry = whole_point(geometry)
        coords = F.when(geometry.isNotNull(), _coords(geometry))
    elif kind == "LineString":
        coords = F.transform(geometry, _coords)
    elif kind == "Polygon":
        coords = F.transform(geometry, lambda ring: F.transform(ring, _coords))
    else:
        raise ValueError(f"unknown geometry kind: {kind}")
    shape = F.when(geometry.isNotNull(), F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")))
    return F.to_json(
        F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), shape.alias("geometry")),
        {"ignoreNullFields": "false"},
    )


def feature_kind(text: Column) -> Column:
    return F.get_json_object(text, "$.geometry.type")


def feature_parts(text: Column) -> Column:
    """Coordinates, as text, of each part of a feature: several for a Multi* geometry, else one."""
    raw = F.get_json_object(text, "$.geometry.coordinates")
    return F.when(feature_kind(text).startswith("Multi"), F.from_json(raw, "array<string>")).otherwise(F.array(raw))


def feature_coordinates(raw: Column, kind: str) -> Column:
    """Coordinates text of one part as struct or arrays of structs."""

    def xy(a):
        return point(F.get(a, F.lit(0)), F.get(a, F.lit(1)))
    if kind == "Point":
        parsed = F.from_json(raw, "array<double>")
        return F.when(parsed.isNotNull(), xy(parsed))
    if kind == "LineString":
        return F.transform(F.from_json(raw, "array<array<double>>"), xy)
    if kind == "Polygon":
        return F.transform(F.from_json(raw, "array<array<array<double>>>"), lambda ring: F.transform(ring, xy))
    raise ValueError(f"unknown geometry kind: {kind}")
