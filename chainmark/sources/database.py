"""Layers in a database, and layers clipped from a shared table. Reads and writes go through Spark's JDBC source."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.constants import LAYER_KINDS
from chainmark.functions.geometry import wkt_kind
from chainmark.operators.spatial import clip_lines, clip_points


def _quoted(value) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError("filters take text and numbers")
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def layer_predicates(filters: Mapping[str, object] | None, label: str | None = None, project_id: str | None = None) -> list[str]:
    """Equality and membership conditions of a layer query."""
    terms = [] if label is None else [f"label = {_quoted(label)}"]
    terms += [] if project_id is None else [f"project_id = {_quoted(project_id)}"]
    for column, value in (filters or {}).items():
        if not column.replace("_", "").isalnum():
            raise ValueError(f"not a column name: {column}")
        if isinstance(value, (list, tuple, set)):
            terms.append(f"{column} IN ({', '.join(_quoted(v) for v in sorted(value))})")
        else:
            terms.append(f"{column} = {_quoted(value)}")
    return terms


def read_layer(
    spark: SparkSession, url: str, table: str, label: str | None = None, project_id: str | None = None,
    filters: Mapping[str, object] | None = None, split_column: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 32, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database layer; conditions are pushed to the database, ``split_column`` reads in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    if split_column and bounds:
        reader = reader.options(partitionColumn=split_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    df = reader.load()
    for term in layer_predicates(filters, label, project_id):
        df = df.where(term)
    return df


def check_kind(df: DataFrame, layer: str, wkt: str = "geometry") -> DataFrame:
    """Rows whose WKT is of the kind the layer must hold."""
    return df.where(wkt_kind(F.col(wkt)) == LAYER_KINDS[layer].upper())


def write_layer(
    df: DataFrame, url: str, table: str, label: str, layer: str, project_id: str | None = None, wkt: str = "geometry",
    partitions: int = 16, options: Mapping[str, str] | None = None,
) -> None:
    """K5: append a layer, geometry as WKT, to a database table; rows of another kind are refused."""
    wrong = df.where(~F.coalesce(wkt_kind(F.col(wkt)) == LAYER_KINDS[layer].upper(), F.lit(False)))
    if wrong.limit(1).count():
        raise ValueError(f"layer {layer} must hold {LAYER_KINDS[layer]} only")
    out = df.withColumn("label", F.lit(label)).withColumn("project_id", F.lit(project_id).cast("string"))
    out.write.format("jdbc").options(url=url, dbtable=table, numPartitions=partitions, batchsize=10000, **(options or {})).mode("append").save()


def _rows_mark(df: DataFrame) -> str:
    """Number of rows, and a sum of their hashes, which does not depend on their order; maps are taken as sorted entries."""
    def plain(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        return F.array_sort(F.map_entries(col)) if isinstance(field.dataType, T.MapType) else col

    fields = sorted(df.schema.fields, key=lambda f: f.name)
    # A hash skips nulls; the text form names them, also inside structs and lists.
    row = F.to_json(F.struct(*[plain(f).alias(f.name) for f in fields]), {"ignoreNullFields": "false"})
    sums = [F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")) for seed in (1, 2)]
    found = df.agg(F.count(F.lit(1)), *[F.coalesce(s, F.lit(0)) for s in sums]).first()
    return f"{[(f.name, f.dataType.simpleString()) for f in fields]} {[int(v) for v in found]}"


def layer_fingerprint(source: DataFrame, areas: DataFrame, *options) -> str:
    """Name of a clip: equal for equal rows of source and boundary, in any order, and equal options."""
    text = "\n".join([_rows_mark(source), _rows_mark(areas), repr(options)])
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def clipped_layer(
    spark: SparkSession, source: DataFrame, areas: DataFrame, path: str, kind: str, key: str = "id", refresh: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The part of a shared feature table inside the boundary, stored once per project below ``path``.

    Each clip is a snapshot of its own, named by a fingerprint of the rows of source and boundary, the kind, the key and the kept
    columns; ``current_layer`` reads the one that was asked for last. A snapshot counts once it is whole (``_SUCCESS``), and is
    named current only then, so a write that fails leaves the earlier rows as they are. ``refresh`` writes the snapshot anew under
    another name. Older snapshots stay for their readers; remove them with the folder. Two writers of one clip write two snapshots.
    """
    name = layer_fingerprint(source, areas, kind, key, list(keep or ()))
    whole = _whole_snapshots(spark, path)
    known = [n for n in whole if n.split("-")[0] == name]
    chosen = max(known, key=whole.get) if known and not refresh else f"{name}-{uuid.uuid4().hex}"
    if chosen not in known:
        part = clip_points(source, areas) if kind == "Point" else clip_lines(source, areas, key)
        (part.select(*keep) if keep else part).write.parquet(f"{path}/snapshots/{chosen}")
    if _pointed(spark, path) != chosen:
        _point_to(spark, path, chosen)
    return spark.read.parquet(f"{path}/snapshots/{chosen}")


def current_layer(spark: SparkSession, path: str) -> DataFrame:
    """The clip stored below ``path`` that was asked for last."""
    name = _pointed(spark, path)
    if name is None:
        raise ValueError(f"no clip is stored at {path}")
    return spark.read.parquet(f"{path}/snapshots/{name}")


def _files(spark: SparkSession, path: str):
    """The file system of a path, of any kind that Spark writes to, and the path as it knows it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> dict[str, int]:
    files, at = _files(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(at)} if files.exists(at) else {}


def _whole_snapshots(spark: SparkSession, path: str) -> dict[str, int]:
    """Snapshots whose write came to its end, with the time of their folder."""
    def whole(name: str) -> bool:
        files, at = _files(spark, f"{path}/snapshots/{name}/_SUCCESS")
        return files.exists(at)

    return {n: t for n, t in _names(spark, f"{path}/snapshots").items() if whole(n)}


def _pointed(spark: SparkSession, path: str) -> str | None:
    """Pointers are numbered empty files; the highest number counts."""
    named = sorted((int(n.split("_")[0]), n.split("_")[1]) for n in _names(spark, f"{path}/pointers") if n[0].isdigit())
    return named[-1][1] if named else None


def _point_to(spark: SparkSession, path: str, name: str) -> None:
    taken = [int(n.split("_")[0]) for n in _names(spark, f"{path}/pointers") if n[0].isdigit()]
    files, at = _files(spark, f"{path}/pointers/{max(taken, default=0) + 1:012d}_{name}")
    files.create(at, False).close()
