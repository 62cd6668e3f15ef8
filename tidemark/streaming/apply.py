"""Targets that streaming micro-batches are applied to: a change log, a view over it, and a batch compaction.

A micro-batch is appended to the log as it is, in a partition of its own number: a batch of 200 rows writes 200 rows, and
a repeated batch replaces its own partition, also with no rows. What users see is a query (type 1, type 2 or deduplicated
rows) over the last compaction and the log since. ``compact`` is a batch job that writes that state.

The compacted state of a merge target is laid out by buckets of the key's hash. Changes are merged with the rows of
their own buckets only: the others are passed through by a read, without a shuffle, and left as they are by a compaction. What is
compacted, or applied as a snapshot, counts once one small row about it has been written, which is the last write; readers
follow these rows, so a half-written version is never seen and a version may be empty. Everything is a native parquet write into
a folder of its own, published by Spark's own commit, and a native partition-pruned read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import change as ch
from tidemark.operators.ordered import default_parts
from tidemark.session import shared_file_system

BATCH, FLOW, THROUGH, BUCKET = "__batch", "__flow", "__through", "__bucket"


def _numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of a table's first partition column, from the folder names."""
    fs, p = shared_file_system(spark, path)
    if not fs.exists(p(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p(path))]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"{column}=(-?\d+)", n)))


class Published:
    """One row for each version of a table: written last, it makes the version count."""

    SCHEMA = "version bigint, rows bigint, checksum string, buckets array<bigint>"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/published"

    def add(self, version: int, rows: int | None = None, checksum: str | None = None, buckets: list[int] | None = None) -> None:
        row = self.spark.createDataFrame([(version, rows, checksum, buckets)], self.SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{THROUGH}={version}")

    def versions(self) -> list[int]:
        fs, p = shared_file_system(self.spark, self.path)
        return [n for n in _numbers(self.spark, self.path, THROUGH) if fs.exists(p(f"{self.path}/{THROUGH}={n}/_SUCCESS"))]

    def last(self) -> int | None:
        return max(self.versions(), default=None)

    def row(self, version: int):
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{THROUGH}={version}").first()

    def forget(self, versions: list[int]) -> None:
        fs, p = shared_file_system(self.spark, self.path)
        for n in versions:
            fs.delete(p(f"{self.path}/{THROUGH}={n}"), True)


class ChangeLog:
    """The log of a table's micro-batches and the last compaction of the state they make."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        self.published = Published(spark, self.path)

    def append(self, batch: DataFrame, batch_id: int, flow: str) -> None:
        batch.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/log/{BATCH}={batch_id}/{FLOW}={flow}")

    def through(self) -> int:
        """The last batch that the last compaction holds; -1 without one."""
        last = self.published.last()
        return -1 if last is None else last

    def last(self) -> int:
        return max(_numbers(self.spark, f"{self.path}/log", BATCH), default=-1)

    def since(self, number: int) -> DataFrame:
        """Log rows of batches after ``number``; the scan skips the other partitions."""
        if not _numbers(self.spark, f"{self.path}/log", BATCH):
            return self.spark.createDataFrame([], self.schema)
        full = T.StructType([*self.schema, T.StructField(BATCH, T.LongType()), T.StructField(FLOW, T.StringType())])
        return self.spark.read.schema(full).parquet(f"{self.path}/log").filter(F.col(BATCH) > number).select(*self.schema.names)

    def base(self, schema: T.StructType) -> DataFrame:
        """The last compaction's rows of the given columns, and ``__bucket`` where it has buckets."""
        at = self.published.last()
        if at is None:
            return self.spark.createDataFrame([], schema)
        buckets = self.published.row(at).buckets
        parts = [T.StructField(THROUGH, T.LongType()), *([T.StructField(BUCKET, T.IntegerType())] if buckets else [])]
        rows = self.spark.read.schema(T.StructType([*schema, *parts])).parquet(f"{self.path}/base")
        if not buckets:
            return rows.filter(F.col(THROUGH) == at).drop(THROUGH)
        of: dict[int, list[int]] = {}
        for bucket, version in enumerate(buckets):
            of.setdefault(version, []).append(bucket)
        current = [(F.col(THROUGH) == v) & F.col(BUCKET).isin(b) for v, b in of.items() if v >= 0]
        return rows.filter(reduce(lambda a, b: a | b, current, F.lit(False))).drop(THROUGH)

    def publish(self, state: DataFrame, through: int, buckets: list[int] | None = None) -> None:
        """Write ``state`` as of batch ``through``. With ``buckets``, for each bucket the batch as of which it was written last,
        ``state`` has ``__bucket`` and holds those written now."""
        writer = state.write.mode("overwrite")
        (writer.partitionBy(BUCKET) if buckets else writer).parquet(f"{self.path}/base/{THROUGH}={through}")
        self.published.add(through, buckets=buckets)

    def forget(self, keep: int = 1) -> None:
        """Delete compactions but the last ``keep``, and the log that the oldest of those holds."""
        done = self.published.versions()
        if not done:
            return
        fs, p = shared_file_system(self.spark, self.path)
        rows = {n: self.published.row(n).buckets for n in done[-keep:]}
        self.published.forget(done[:-keep])
        whole = {n for n, b in rows.items() if not b}
        used = {(v, k) for b in rows.values() for k, v in enumerate(b or [])}
        for n in _numbers(self.spark, f"{self.path}/base", THROUGH):
            folder = f"{self.path}/base/{THROUGH}={n}"
            held = _numbers(self.spark, folder, BUCKET)
            if n > done[-1] or n in whole:
                continue
            if not any((n, k) in used for k in held):
                fs.delete(p(folder), True)
            for k in held:
                if (n, k) not in used:
                    fs.delete(p(f"{folder}/{BUCKET}={k}"), True)
        for n in _numbers(self.spark, f"{self.path}/log", BATCH):
            if n <= done[-keep:][0]:
                fs.delete(p(f"{self.path}/log/{BATCH}={n}"), True)


class MergeTarget:
    """Type 1 or type 2 target. The compacted state keeps tombstones and, for type 2, every event of a key, so late
    and repeated rows give the same result as one batch.

    ``buckets`` is how many the first compaction lays the state out in (default: one for each shuffle partition);
    later ones keep that number, and ``compact(buckets=...)`` lays everything out anew.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], seq: str, scd_type: int = 1,
        cluster_by: list[str] | None = None, buckets: int | None = None,
    ):
        self.spark, self.keys, self.seq, self.scd_type, self.cluster_by, self.buckets = spark, keys, seq, scd_type, cluster_by, buckets
        fields = [f for f in schema if f.name not in (ch.DELETED, ch.START_AT, ch.END_AT)]
        self.log = ChangeLog(spark, path, T.StructType([*fields, T.StructField(ch.DELETED, T.BooleanType(), True)]))
        interval = [T.StructField(c, self.log.schema[seq].dataType) for c in (ch.END_AT, ch.START_AT)] if scd_type == 2 else []
        self.schema = T.StructType([*self.log.schema, *interval])

    def apply(self, batch: DataFrame, batch_id: int, flow: str = "changes") -> None:
        """Append one micro-batch; meant for ``foreachBatch``."""
        if ch.DELETED not in batch.columns:
            batch = batch.withColumn(ch.DELETED, F.lit(False))
        self.log.append(batch, batch_id, flow)

    def _usable(self, rows: DataFrame) -> DataFrame:
        return ch.split_null_sequence(rows, self.keys, self.seq)[0]

    def _merged(self, events: DataFrame) -> DataFrame:
        if self.scd_type == 2:
            return ch.scd2_versions(events, self.keys, self.seq, ch.DELETED).select(*self.schema.names)
        return ch.latest(events, self.keys, self.seq, ch.DELETED)

    def _bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(count)).cast("int")

    def _layout(self) -> list[int] | None:
        """For each bucket the batch as of which it was written last; None without a compaction."""
        at = self.log.published.last()
        return None if at is None else self.log.published.row(at).buckets

    def state(self) -> DataFrame:
        """All state rows, tombstones included.

        The buckets that the log since the last compaction touches, one small row each, prune the scan of the rows that are merged
        with it; the rows of other buckets are taken as they are.
        """
        since = self.log.since(self.log.through())
        layout = self._layout()
        if layout is None:
            return self._merged(self._usable(since))
        base = self._usable(self.log.base(self.schema))
        touched = F.broadcast(since.select(self._bucket(len(layout)).alias(BUCKET)).distinct())  # as many rows as buckets at most
        old = base.join(touched, BUCKET, "left_semi").select(*self.log.schema.names)
        merged = self._merged(self._usable(old.unionByName(since)))
        return base.join(touched, BUCKET, "left_anti").select(*self.schema.names).unionByName(merged)

    def read(self) -> DataFrame:
        """The target as its users see it."""
        return self.state().filter(~F.coalesce(F.col(ch.DELETED), F.lit(False))).drop(ch.DELETED)

    def quarantine(self) -> DataFrame:
        """Rows without key or sequence, which cannot be applied; compactions keep them."""
        rows = self.log.base(self.schema).select(*self.log.schema.names).unionByName(self.log.since(self.log.through()))
        return ch.split_null_sequence(rows, self.keys, self.seq)[1]

    def touched(self) -> list[int]:
        """The buckets of the last compaction that the log since touches: as many numbers as buckets at most."""
        layout = self._layout() or []
        rows = self.log.since(self.log.through()).select(self._bucket(max(len(layout), 1)).alias("b")).distinct()
        return sorted(r.b for r in rows.collect())

    def old_rows(self, buckets: list[int]) -> DataFrame:
        """The compacted rows of some buckets; the scan reads no others."""
        return self.log.base(self.schema).filter(F.col(BUCKET).isin(buckets)).select(*self.log.schema.names)

    def compact(self, buckets: int | None = None) -> int:
        """Write the state as of the last batch; returns that batch's number. Only buckets with changes are read and written;
        ranges of the key and the row's hash lay out their files, so a key with a long history spans several."""
        last, layout = self.log.last(), self._layout()
        if last <= self.log.through() and (buckets is None or layout is None or buckets == len(layout)):
            return self.log.through()
        if layout is None or (buckets is not None and buckets != len(layout)):
            last = max(last, self.log.through())
            layout = [last] * (buckets or self.buckets or default_parts(self.log.since(-1)))
            events = self.log.base(self.schema).select(*self.log.schema.names).unionByName(self.log.since(self.log.through()))
            if last == self.log.through():
                raise ValueError("a new layout takes a new batch: nothing was appended since the last compaction")
        else:
            changed = self.touched()
            layout = [last if k in set(changed) else v for k, v in enumerate(layout)]
            events = self.old_rows(changed).unionByName(self.log.since(self.log.through()))
        apart = ch.split_null_sequence(events, self.keys, self.seq)[1]
        state = self._merged(self._usable(events)).unionByName(apart, allowMissingColumns=True)
        state = state.withColumn(BUCKET, self._bucket(len(layout)))
        cols = [BUCKET, *(self.cluster_by or self.keys)]
        laid = state.repartitionByRange(default_parts(state), *cols, ch.row_hash(state, state.columns))
        self.log.publish(laid.sortWithinPartitions(*cols), last, layout)
        return last


class AppendTarget:
    """Append target of which users see one row for each value of ``dedupe_keys``: the first by cursor (nulls first), then by
    hash, so a redelivered row, with or without key and cursor, is seen once.

    Without ``dedupe_keys`` use the native file sink instead (see ``read.append_stream``).
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, dedupe_keys: list[str], cursor: str | None = None):
        self.spark, self.keys, self.cursor = spark, dedupe_keys, cursor
        self.log = ChangeLog(spark, path, schema)

    def apply(self, batch: DataFrame, batch_id: int, flow: str = "append") -> None:
        self.log.append(batch, batch_id, flow)

    def read(self) -> DataFrame:
        rows = self.log.base(self.log.schema).unionByName(self.log.since(self.log.through()))
        rest = [c for c in rows.columns if c not in self.keys]
        order = [*([F.col(self.cursor)] if self.cursor else []), ch.row_hash(rows, rows.columns)]
        first = rows.groupBy(*self.keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
        return first.select(*[F.col(c) if c in self.keys else F.col("__row")[c].alias(c) for c in rows.columns])

    def compact(self) -> int:
        last = self.log.last()
        if last > self.log.through():
            self.log.publish(self.read(), last)
        return last


class SnapshotTarget:
    """Target fed by whole snapshots: type 1 becomes the snapshot, type 2 keeps the history. A snapshot may be empty.

    Open rows are written with every snapshot; rows that a snapshot closes go to a folder of their own, once. Both count
    from when the snapshot's row is published.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], scd_type: int = 1):
        self.spark, self.path, self.keys, self.scd_type = spark, path.rstrip("/"), keys, scd_type
        self.published = Published(spark, self.path)

    def version(self) -> int | None:
        """The number of the last snapshot."""
        return self.published.last()

    def _open(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/open/{THROUGH}={version}")

    def read(self) -> DataFrame | None:
        at = self.version()
        if at is None:
            return None
        rows = self._open(at)
        if self.scd_type == 2:
            closed = T.StructType([*rows.schema, T.StructField(THROUGH, T.LongType())])
            old = self.spark.read.schema(closed).parquet(f"{self.path}/closed").filter(F.col(THROUGH) <= at)
            rows = rows.unionByName(old.drop(THROUGH))
        return rows

    def apply(self, snap: DataFrame, version: int | None = None) -> int:
        """Apply the next snapshot. Without a number it is the last one's plus 1. An old number again must come with
        the same rows, and changes nothing."""
        last = self.version()
        if version is None:
            version = 0 if last is None else last + 1
        rows, checksum = _mark(snap)
        if last is not None and version <= last:
            if version in self.published.versions():
                known = self.published.row(version)
                if (known.rows, known.checksum) == (rows, checksum):
                    return version
            raise ValueError(f"{self.path}: snapshot {version} was applied before with other rows; the last is {last}")
        at = F.lit(version).cast("bigint")
        if self.scd_type == 1:
            snap.write.mode("overwrite").parquet(f"{self.path}/open/{THROUGH}={version}")
        else:
            now = ch.open_history(snap, at) if last is None else ch.apply_snapshot_scd2(self._open(last), snap, self.keys, at)
            over = F.col(ch.END_AT).isNotNull()
            now.filter(over).write.mode("overwrite").parquet(f"{self.path}/closed/{THROUGH}={version}")
            now.filter(~over).write.mode("overwrite").parquet(f"{self.path}/open/{THROUGH}={version}")
        self.published.add(version, rows, checksum)
        return version


def _mark(df: DataFrame) -> tuple[int, str]:
    """(rows, checksum) of the multiset of rows."""
    h = ch.row_hash(df, df.columns).cast("decimal(38,0)")
    rows, checksum = df.agg(F.count(F.lit(1)), F.sum(h).cast("string")).first()
    return rows, checksum or "0"
