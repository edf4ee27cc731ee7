"""Session settings, the shared scratch folder and reliable checkpoints."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_SCRATCH: list[str] = []


def local_session(cpus: str | int = "*", app: str = "chainmark") -> SparkSession:
    """A session for tests and for the benchmark; a cluster brings its own."""
    partitions = str(cpus) if str(cpus).isdigit() else str(os.cpu_count() or 8)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, or an own one only where none is set."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="chainmark-checkpoint-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for tables written and read back; ``clear_scratch`` deletes them."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once as Parquet in the shared folder, so that later uses read only the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables under scratch paths of this process; call it when no result reads them any more."""
    jvm, count = spark.sparkContext._jvm, 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        count += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return count


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder, so that later uses see one fixed copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
