"""Joins and stored tables that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmark.operators.scale import measured_bytes
from chainmark.session import scratch_path

#: A side is broadcast only when its measured bytes are at most this; beyond, both sides shuffle.
BROADCAST_BYTES = 16 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Stands for a null id where ids are join keys.
NO_ID = -(1 << 63)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: one fixed copy, read with column pruning.

    The shuffle files of the write go when it ends, as nothing reads them again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sized_join(large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join on equal names; ``small`` (a stored table) is broadcast when measured small, else both sides shuffle
    and adaptive execution splits hot keys."""
    if how in ("inner", "left", "left_semi", "left_anti") and measured_bytes(small) <= limit:
        return large.join(F.broadcast(small), list(on), how)
    return large.join(small, list(on), how)


def id_key(col: str = "doc_id") -> Column:
    """A long that stands for the id, also for a null one."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))
