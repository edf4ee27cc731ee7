"""Building blocks that keep joins, scans and numbering spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmark.session import checkpointed

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_ROWS = 4_000_000


def _width(kind: T.DataType, col: Column) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + F.lit(16)
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [_width(f.dataType, col[f.name]) for f in kind], F.lit(16))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.ArrayType, T.StructType)):
            inner = F.aggregate(col, F.lit(0).cast("long"),
                                lambda acc, e: acc + _width(kind.elementType, e).cast("long"))
            return F.coalesce(inner, F.lit(0)) + F.lit(16)
        return F.coalesce(F.size(col), F.lit(0)) * F.lit(8) + F.lit(16)
    return F.lit(8)


def row_bytes(df: DataFrame, names: Sequence[str] | None = None) -> Column:
    """Bytes a row takes, from its values."""
    fields = [f for f in df.schema if names is None or f.name in names]
    return reduce(lambda a, b: a + b, [_width(f.dataType, F.col(f"`{f.name}`")) for f in fields], F.lit(16)).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Bytes all rows take, by one aggregation over them."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()["b"]


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    condition: Column | None = None,
    how: str = "left",
    limit_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    dim_bytes: int | None = None,
) -> DataFrame:
    """Join a large table to a smaller one on equal keys, with an optional residual condition.

    The smaller side is broadcast only after its size was measured (or given as ``dim_bytes``); beyond the
    limit both sides shuffle on the keys, and keys with more than ``hot_rows`` rows are salted.
    Columns other than the keys must have different names on the two sides.
    """
    size = measured_bytes(dim) if dim_bytes is None else dim_bytes
    if size <= limit_bytes:
        return _join(fact, F.broadcast(dim), on, condition, how)
    return salted_join(fact, dim, on, condition, how, hot_rows)


def shuffled(df: DataFrame) -> DataFrame:
    """The side of a join that was not measured: both sides are sorted and merged.

    Left to itself Spark broadcasts by an estimate, which takes neither exploded rows nor compressed files into account.
    """
    return df.hint("merge")


def _join(fact: DataFrame, dim: DataFrame, on: Sequence[str], condition: Column | None, how: str) -> DataFrame:
    renamed = dim.select([F.col(c).alias(f"_dim_{c}") if c in on else F.col(c) for c in dim.columns])
    terms = [F.col(k) == F.col(f"_dim_{k}") for k in on] + ([] if condition is None else [condition])
    joined = fact.join(renamed, reduce(lambda a, b: a & b, terms), how)
    return joined.drop(*[f"_dim_{k}" for k in on])


def salted_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], condition: Column | None = None, how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Shuffle join that spreads each key with more than ``hot_rows`` rows over several tasks.

    The salt is a hash of the row, so a task that runs again deals its rows alike. Rows with a null key match
    nothing and go around the join. The table of hot keys is measured before it is broadcast.
    """
    keys = list(on)
    bare = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    around, fact = fact.where(bare), fact.where(~bare)
    hot = checkpointed(
        fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("long").alias("_ways"))
    )
    listed = F.broadcast(hot) if measured_bytes(hot) <= BROADCAST_BYTES else shuffled(hot)
    fact_salted = (
        _join(fact, listed, keys, None, "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.col("_ways")), F.lit(0).cast("long")))
        .drop("_ways")
    )
    dim_salted = (
        _join(dim, listed, keys, None, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_ways"), F.lit(1).cast("long")) - 1)))
        .drop("_ways")
    )
    joined = _join(fact_salted, shuffled(dim_salted), keys + ["_salt"], condition, how).drop("_salt")
    if how == "left":
        return joined.unionByName(around, allowMissingColumns=True).select(*joined.columns)
    return joined.unionByName(around) if how == "left_anti" else joined


def running_sum(df: DataFrame, keys: Sequence[str], seq: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the same keys, where ``seq`` numbers the rows densely.

    Works in blocks of ``block`` rows: totals per block, prefix over the few totals, then a short window in
    each block. No task ever sorts a whole key.
    """
    keys = list(keys)
    blocked = df.withColumn("_block", F.floor(F.col(seq) / F.lit(block)))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        blocked.groupBy(*keys, "_block").agg(F.sum(value).alias("_total"))
        .select(*keys, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0.0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0.0)))
        .join(shuffled(totals), keys + ["_block"])
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_block", "_before", "_inside")
    )


def numbered(df: DataFrame, order: Sequence[str], out: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in the given order, without sending all rows through one task.

    Rows are range-partitioned and sorted, written once, counted per partition; the prefix sum over the
    partition counts (one row per partition) gives each partition its offset.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = 1 << 33
    ranged = checkpointed(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.floor(F.col("_mid") / F.lit(split)))
        .withColumn("_local", F.pmod(F.col("_mid"), F.lit(split)))
        .drop("_mid")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_offset"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_local") + F.lit(start))
        .drop("_part", "_local", "_offset")
    )


def padded_id(prefix: str, number: Column) -> Column:
    """Text id such as ``fd-00001``."""
    return F.format_string(f"{prefix}-%05d", number)
