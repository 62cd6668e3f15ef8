"""Helpers of the training-data operators: how functions reach the workers, text access, scratch tables, folds."""

from __future__ import annotations

import gc
import os
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send the functions of ``module`` to the workers by value, so they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id's text modulo ``folds`` is ``fold``; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a local session without that setting gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "tidemark-llm")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later plan reads."""
    for t in tables:
        p = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t._scratch)
        p.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer held; it does so when the JVM collects garbage, which a
    driver with little to do puts off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows that go to a Python worker at once, so that a batch of long texts stays small.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit of rows in an Arrow batch to ``BATCH_ROWS``."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Run Python over ``df`` in Arrow batches.

    ``make()`` is called once in each task and returns ``fn(columns) -> columns``, where columns
    are lists (or Arrow arrays) in schema order. Memory is bounded by one batch.
    """
    small_batches(df.sparkSession)
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            for start in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(start, BATCH_ROWS)
                cols = fn([c.to_pylist() for c in part.columns])
                if cols and len(cols[0]):
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(cols, target)], schema=target
                    )
        if hasattr(fn, "rest"):
            cols = fn.rest()
            if cols and len(cols[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, target)], schema=target)

    return df.mapInArrow(run, schema)


def labelled_sample(labels: DataFrame, column: str, folds: int, fold: int, bound: int) -> DataFrame:
    """At most ``bound`` training rows (doc_id, label) in hash order: conflicting, null and held-out ids take no part.

    The bound makes the result safe to broadcast.
    """
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    one = ids.groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("_other")).filter("label = _other")
    return one.select("doc_id", F.col("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def labelled_rows(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, text, label) of a ``labelled_sample``: one row for each id, however many documents have it, the one with the
    least hash of its text. So the sample's bound is one of rows too."""
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct("text", "label"), F.xxhash64("text")).alias("_one"))
    return one.select("doc_id", "_one.text", "_one.label")
