"""Running streams to the end of what is there now."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append flow without keys: the native file sink, exactly once through its own log."""
    return (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def apply_stream(df: DataFrame, target, checkpoint: str, flow: str = "changes") -> StreamingQuery:
    """Change flow: every micro-batch is merged into the target once."""
    return (
        df.writeStream.foreachBatch(lambda batch, batch_id: target.apply(batch, batch_id, flow))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def rocksdb_state(spark: SparkSession) -> None:
    """Streaming state in RocksDB: on the executors' disks, with changes in the checkpoint, so it may exceed their memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def dedup_stream(df: DataFrame, keys: list[str], ts: str, horizon: str) -> DataFrame:
    """The first row of each key; redelivered ones are dropped within ``horizon`` of their time, also after a restart.

    State holds the keys since the watermark, no more: a key that comes again later than that is a new one, and rows older than the
    watermark are late and dropped. ``horizon`` must cover the lookback of the source.
    """
    return df.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


def join_streams(parents: DataFrame, children: DataFrame, on: str, parent_ts: str, child_ts: str, within: str) -> DataFrame:
    """Children with their parents' columns, both streams; either may be late by up to ``within``, and a pair's times
    may be so far apart. State holds what can still find a partner. The same rows as the batch join, however the streams are cut.
    """
    p = parents.withWatermark(parent_ts, within).withColumnRenamed(on, "__parent")
    c = children.withWatermark(child_ts, within)
    span = F.expr(f"interval {within}")
    near = (F.col(child_ts) >= F.col(parent_ts) - span) & (F.col(child_ts) <= F.col(parent_ts) + span)
    return c.join(p, (F.col(on) == F.col("__parent")) & near).drop("__parent")


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now query; its error is raised here."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
