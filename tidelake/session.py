"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from typing import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join below a window or an aggregate is split too; the extra exchange is cheaper than one huge task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Rows that reach a Python worker at once: whole texts may be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Settings that must be there when the session starts.
STATIC_CONF = {
    # Plans with hundreds of expressions are built several times faster without a call-site record per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidelake", master: str | None = None, conf: Mapping[str, str] | None = None) -> SparkSession:
    """Create a session with all settings, and those of ``conf`` on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF}.items():
        builder = builder.config(key, value)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a folder below the home directory of Hadoop's default file system is taken, which all machines
    of a cluster share. A default file system that is local serves a local master only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        fs = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
        if fs.getScheme() != "file":
            root = f"{fs.getHomeDirectory().toString()}/tidelake-scratch"
        elif spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
            root = f"/tmp/tidelake-scratch-{os.getuid()}"
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return f"{scratch_root(spark)}/tidelake/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Cut the lineage by a table in the shared folder, so that lost executors cost no recomputation."""
    path = scratch(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def file_per_task(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside give every file a task of its own: files that compress well are not packed into tasks of very many rows."""
    with _setting(spark, "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")):
        yield


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Plans of jobs started inside whose generated method is longer than the JVM compiles (8,000 bytes) are run operator by operator."""
    with _setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000"):
        yield


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
