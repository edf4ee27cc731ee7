"""Vector layers: GeoJSON in and out, kinds, precision, and areas that clip them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.constants import LAYER_KINDS, LAYER_LINES
from chainmark.functions.columns import union_all
from chainmark.functions.geometry import feature_coordinates, feature_json, feature_kind, feature_parts, snap_grid
from chainmark.operators.scale import lookup_join
from chainmark.session import stored


def features_of(texts: DataFrame, kind: str, properties: T.StructType | None = None, snap: bool = True) -> DataFrame:
    """Feature texts (column ``value``) of one geometry kind as rows.

    With a ``properties`` schema its fields become columns, otherwise one text map. Each part of a Multi*
    geometry of the kind is a row. Features of another kind are left out; ``rejected`` counts them.
    """
    schema = properties or T.MapType(T.StringType(), T.StringType())
    rows = texts.where(feature_kind(F.col("value")).isin(kind, f"Multi{kind}")).select(
        F.from_json(F.get_json_object("value", "$.properties"), schema).alias("properties"), F.explode(feature_parts(F.col("value"))).alias("_part"))
    rows = rows.select("properties", feature_coordinates(F.col("_part"), kind).alias("geometry"))
    if snap:
        g = F.col("geometry")
        if kind == "Point":
            g = F.get(snap_grid(F.array(g)), F.lit(0))
        elif kind == "LineString":
            g = snap_grid(g)
        else:
            g = F.transform(g, lambda ring: snap_grid(ring))
        rows = rows.withColumn("geometry", g)
    return rows.select("properties.*", "geometry") if properties else rows


def feature_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One feature per row from files that hold one feature, or a whole collection, per line, as text."""
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    value = F.regexp_replace(F.trim("value"), r",$", "")
    kind = F.get_json_object("value", "$.type")
    listed = F.from_json("value", "features array<string>")["features"]
    each = F.when(kind == "FeatureCollection", listed).when(kind == "Feature", F.array("value"))
    return lines.select(value.alias("value")).select(F.explode(each).alias("value"))


#: What precedes the next opening brace outside texts.
_LEAD = r'(?s)^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+'


def _sum_before(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Sum of a column over all earlier pieces of the file: within the block, plus the totals of the blocks before."""
    inside = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file", "block").agg(F.sum(value).alias("_sum")).select("file", "block", F.coalesce(F.sum("_sum").over(blocks), F.lit(0)).alias("_base"))
    here = rows.withColumn("_here", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return lookup_join(here, totals, ["file", "block"], how="inner").withColumn(out, F.col("_base") + F.col("_here")).drop("_base", "_here")


def feature_texts_split(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One feature per row from files that each hold one collection, on one line or on many; a large file is many tasks.

    Files are read in pieces that end at closing braces, wherever those are. Sums over the pieces then tell which pieces start
    inside a text and how deep each is; a feature ends where the depth falls to that of the collection. Members of the collection
    that are objects of another type are left out. A task holds the pieces of one block of a file, and each feature is one value.
    Compressed files are one block. A path given twice is read twice; one file by different paths is not provided for.
    """
    given = Counter([paths] if isinstance(paths, str) else paths)
    found = [_split_once(spark, [p for p, times in given.items() if times > k]) for k in range(max(given.values()))]
    return reduce(DataFrame.unionByName, found)


def _split_once(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "}").text(list(paths))
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # no escape ends in a brace, so none is cut
    outside = r'"[^"]*+(?:"|$)'

    def opens(text: Column) -> Column:
        return F.length(F.regexp_replace(F.regexp_replace(text, outside, ""), r"[^{]++", "")).cast("long")

    pieces = stored(lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value",
        F.length(F.regexp_replace(bare, r'[^"]++', "")).cast("long").alias("quotes"), opens(bare).alias("opens"), opens(F.concat(F.lit('"'), bare)).alias("opens_quoted")), "pieces")
    rows = _sum_before(pieces.drop("value"), "quotes", "q")
    opened = F.when(F.col("q") % 2 == 0, F.col("opens")).otherwise(F.col("opens_quoted"))
    closed = F.when((F.col("q") + F.col("quotes")) % 2 == 0, 1).otherwise(0).cast("long")
    rows = stored(rows.select("file", "block", "n", (opened - closed).alias("change"), closed.alias("closed")), "piece-depths")
    rows = _sum_before(rows, "change", "before")
    ends = ((F.col("closed") == 1) & (F.col("before") + F.col("change") == 1)).cast("long")
    rows = stored(rows.select("file", "block", "n", ends.alias("ends")), "piece-ends")
    rows = _sum_before(rows, "ends", "feature")
    texts = pieces.select("file", "block", "n", "value").join(rows, ["file", "block", "n"])
    each = texts.groupBy("file", "feature").agg(F.array_sort(F.collect_list(F.struct("block", "n", "value"))).alias("p"), F.max("ends").alias("ends")).where("ends = 1")
    joined = each.select("feature", F.concat(F.array_join(F.col("p.value"), "}"), F.lit("}")).alias("value"))
    opening = F.when(F.col("feature") == 0, F.substr(F.regexp_replace("value", _LEAD, ""), F.lit(2))).otherwise(F.col("value"))
    features = joined.select(F.regexp_replace(opening, _LEAD, "").alias("value"))
    return features.where(F.get_json_object("value", "$.type") == "Feature")


def read_geojson(
    spark: SparkSession, paths: str | Sequence[str], kind: str, properties: T.StructType | None = None,
    multiline: bool = False, snap: bool = True,
) -> DataFrame:
    """A vector layer from one path or several; ``multiline`` for files that each hold one collection, however large."""
    texts = feature_texts_split(spark, paths) if multiline else feature_texts(spark, paths)
    return features_of(texts, kind, properties, snap)


def rejected(texts: DataFrame, layer: str) -> DataFrame:
    """Features whose kind is not the one the layer must hold, counted per kind."""
    return (
        texts.select(feature_kind(F.col("value")).alias("kind"))
        .where(F.coalesce(~F.col("kind").isin(LAYER_KINDS[layer], f"Multi{LAYER_KINDS[layer]}"), F.lit(True)))
        .groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))
    )


def combine_layers(parts: Sequence[DataFrame]) -> DataFrame:
    """S2."""
    return union_all(parts)


def split_layers(centreline: DataFrame, layer: str = "Layer") -> DataFrame:
    """F1/P5: centreline rows of the known layers with their line."""
    line = None
    for name, line_id in LAYER_LINES.items():
        line = F.when(F.col(layer) == name, line_id) if line is None else line.when(F.col(layer) == name, line_id)
    return centreline.withColumn("line_id", line).where(F.col("line_id").isNotNull())


def poi(spark: SparkSession, points: Sequence[tuple[str, float, float]] | None = None) -> DataFrame:
    """The named points of interest."""
    from chainmark.constants import POINTS_OF_INTEREST
    from chainmark.schemas import POINT

    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("geometry", POINT)])
    return spark.createDataFrame([(n, (x, y)) for n, x, y in points or POINTS_OF_INTEREST], schema)


def as_features(df: DataFrame, kind: str, geometry: str = "geometry") -> DataFrame:
    """K1: feature texts, every other column a property."""
    others = [c for c in df.columns if c != geometry]
    return df.select(feature_json(kind, F.col(geometry), F.struct(*others)).alias("value"))
