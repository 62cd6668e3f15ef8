"""Session helpers: the settings the operators rely on and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the one setting that changes results: timestamps are read and rendered in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a ``local`` session (one process, as in tests) gets a folder of its own; for
    any other session that is an error, as a folder of one machine would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "tidemark-scratch")
    return f"{base.rstrip('/')}/tidemark-{purpose}-{uuid.uuid4().hex[:12]}"


def shared_file_system(spark: SparkSession, path: str):
    """(file system, Path class) of ``path`` through Hadoop, so any shared store works."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def checkpointed(df, purpose: str):
    """Cut the lineage of ``df`` with a written table in the shared folder.

    Unlike a local checkpoint the data survives the loss of an executor. ``discard`` deletes it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(table) -> None:
    """Delete a table made by ``checkpointed`` that no later plan reads."""
    fs, path = shared_file_system(table.sparkSession, table._scratch)
    fs.delete(path(table._scratch), True)
