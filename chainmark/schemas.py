"""Explicit schemas of the inputs."""

from pyspark.sql import types as T

TEXT, WHOLE, LONG, NUMBER = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(**groups: list[str]) -> list[T.StructField]:
    kinds = {"text": TEXT, "whole": WHOLE, "long": LONG, "number": NUMBER}
    return [T.StructField(name, kinds[kind]) for kind, names in groups.items() for name in names]


def _struct(*parts: list[T.StructField]) -> T.StructType:
    return T.StructType([field for part in parts for field in part])


POINT = _struct(_schema(number=["x", "y"]))
LINE = T.ArrayType(POINT)
POLYGON = T.ArrayType(LINE)
TAGS = T.ArrayType(TEXT)
DUCT_INFO = _struct(_schema(text=["group_id", "tube_ids"]))
ARCS = T.ArrayType(_struct(_schema(text=["a", "b"])))

LINES = _struct(_schema(text=["line_id"]), [T.StructField("pts", LINE)])

SWITCHES_CSV = _struct(
    _schema(text=["Name", "Network"]), _schema(number=["Chainage 12d (m)", "Offset", "Easting", "Northing"]),
    _schema(text=["RL (m)"]), _schema(number=["Latitude", "Longitude"]))

SWITCH_MARKERS_CSV = _struct(
    _schema(text=["ML/SOL", "POI Type", "Category", "Name"], number=["Meter Marker (m)", "KM", "Lat", "Lon", "Height (m)"]))

SEGMENT_ATTRIBUTES = _struct(_schema(text=["Chainage ID"], number=["Chainage Start (km)", "Chainage End (km)"]))

CURVE_SECTIONS = _struct(_schema(text=["Asset Name", "Section", "Start Chainage (km)", "End Chainage (km)", "Classification", "Hand"]))

_MEASURED = _schema(text=["SF"], whole=["Major"], number=["Minor", "Latitude", "Longitude"])

RP_RAW = _struct(_MEASURED, _schema(number=[
    "East Vertical Wear", "West Vertical Wear", "East Gauge Side Wear", "West Gauge Side Wear",
    "East Relative Head Loss", "West Relative Head Loss"]))

TG_RAW = _struct(_MEASURED, _schema(number=["Speed", "Post Speed"]))

NODES = _struct(
    _schema(text=["node_id", "cand_id"]), [T.StructField("tags", TAGS)],
    _schema(long=["demand"], text=["src", "input_id"]),
    _schema(whole=["size"], text=["placement", "leg", "parcel_id", "access_demand_ids"]),
    [T.StructField("duct_info", DUCT_INFO), T.StructField("geometry", POINT)])

EDGES = _struct(
    _schema(text=["start", "end"]), [T.StructField("tags", TAGS)],
    _schema(text=["src"], whole=["size"], number=["length"]), _schema(text=["placement", "leg"]),
    [T.StructField("arcs", ARCS), T.StructField("duct_info", DUCT_INFO), T.StructField("geometry", LINE)])
