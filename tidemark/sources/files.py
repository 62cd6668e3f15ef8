"""Batch and streaming reads of landed files: native scans, so filters and columns are pushed down."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import coerce
from tidemark.functions.names import report_header
from tidemark.plans.meta import TableMeta

# The keys under which an envelope may hold its records.
ENVELOPES = ["events", "data", "records", "items"]


@dataclass(frozen=True)
class Landed:
    """A table landed as files: where, in which format, and what its source declares."""

    path: str
    meta: TableMeta = field(default_factory=TableMeta)
    schema: T.StructType | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    deletes: str | None = None


def read_batch(spark: SparkSession, src: Landed, options: dict[str, str] | None = None) -> DataFrame:
    """The whole table. JSON records are coerced to the declared schema, the rest is native."""
    opts = {**src.options, **(options or {})}
    if src.format == "json":
        return coerce(spark.read.options(**opts).text(src.path), "value", src.schema)
    reader = spark.read.format(src.format).options(**opts)
    return (reader.schema(src.schema) if src.schema is not None else reader).load(src.path)


def read_stream(spark: SparkSession, src: Landed, files_per_trigger: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """The table as a stream of new files; the checkpoint of the query holds the offset."""
    opts = {**src.options, **(options or {})}
    if files_per_trigger:
        opts["maxFilesPerTrigger"] = str(files_per_trigger)
    if src.format == "json":
        return coerce(spark.readStream.options(**opts).text(src.path), "value", src.schema)
    schema = src.schema
    if schema is None:
        schema = spark.read.format(src.format).options(**src.options).load(src.path).schema
    return spark.readStream.format(src.format).schema(schema).options(**opts).load(src.path)


def read_delete_stream(spark: SparkSession, src: Landed, files_per_trigger: int | None = None) -> DataFrame:
    """Tombstones (keys and cursor) as a second stream with an offset of its own."""
    if not src.deletes:
        raise ValueError("this table has no delete flow")
    wanted = [*src.meta.primary_keys, src.meta.cursor_field]
    base = src.schema if src.schema is not None else spark.read.format(src.format).load(src.path).schema
    keys_only = T.StructType([f for f in base if f.name in wanted])
    flow = Landed(src.deletes, src.meta, keys_only, src.format, src.options)
    return read_stream(spark, flow, files_per_trigger).withColumn("_deleted", F.lit(True))


def _in_range(df: DataFrame, cursor: str, since, until) -> DataFrame:
    """Rows after ``since`` up to ``until``; rows without a cursor are never outside."""
    c, keep = F.col(cursor), F.lit(True)
    if since is not None:
        keep = keep & (c > F.lit(since))
    if until is not None:
        keep = keep & (c <= F.lit(until))
    return df if since is None and until is None else df.filter(c.isNull() | keep)


def read_cursor_stream(spark: SparkSession, src: Landed, since=None, until=None, files_per_trigger: int | None = None) -> DataFrame:
    """The table as a stream by its cursor: new files are the offset, so rows that arrive late with a cursor
    already seen, and rows without one, are delivered; the bounds are pushed to the scan."""
    return _in_range(read_stream(spark, src, files_per_trigger), src.meta.cursor_field, since, until)


def read_partitioned(spark: SparkSession, src: Landed, since=None, until=None) -> DataFrame:
    """The table in one batch, split into tasks by the native scan, with the cursor's bounds pushed to it."""
    return _in_range(read_batch(spark, src), src.meta.cursor_field, since, until)


def read_between(df: DataFrame, cursor: str, start, end) -> DataFrame:
    """Replay of a committed range: after ``start``, up to and including ``end``."""
    out = df.filter(F.col(cursor) <= F.lit(end))
    return out if start is None else out.filter(F.col(cursor) > F.lit(start))


# --- raw text ---------------------------------------------------------------------------


def _records(df: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(record JSON text per row, one row ``bad``): envelopes and lists are unwrapped."""
    v = F.try_parse_json(F.trim(F.col(text)))
    parsed = df.filter(F.trim(text) != "").select(*keep, v.alias("__v"))
    shape = F.schema_of_variant("__v")
    inner: Column = F.when(shape.startswith("ARRAY"), F.try_variant_get("__v", "$", "array<variant>"))
    for key in ENVELOPES:
        found = F.try_variant_get("__v", f"$.{key}", "variant")
        inner = inner.when(
            F.schema_of_variant(found).startswith("ARRAY"), F.try_variant_get(found, "$", "array<variant>")
        )
    items = inner.when(shape.startswith("OBJECT"), F.array("__v"))
    rows = parsed.select(*keep, F.explode(items).alias("__r"))
    good = F.schema_of_variant("__r").startswith("OBJECT")
    bad = parsed.agg(
        F.coalesce(F.sum(F.when(F.col("__v").isNull() | items.isNull(), 1).otherwise(F.size(F.filter(items, lambda x: ~F.schema_of_variant(x).startswith("OBJECT"))))), F.lit(0)).alias("bad")
    )
    return rows.filter(good).select(*keep, F.to_json("__r").alias("record")), bad


def read_ndjson(spark: SparkSession, path: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """One JSON document per line, plain or gzip; bad lines are skipped and counted."""
    return _records(spark.read.options(**options).text(path), "value", [])


def read_json_array(spark: SparkSession, path: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """One JSON document per file (an array or an envelope)."""
    return _records(spark.read.options(**options).text(path, wholetext=True), "value", [])


def read_csv_report(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A report with header, maybe with byte-order mark: lower-case names, empty text is null."""
    raw = spark.read.options(header="true", nullValue="", emptyValue="", multiLine="false", **options).csv(path)
    return raw.toDF(*[report_header(c) for c in raw.columns])


def read_files_modified(spark: SparkSession, path: str, since: dt.datetime | None, until: dt.datetime | None, glob: str | None = None) -> DataFrame:
    """Whole files changed in ``(since, until]`` as (path, modified, text).

    The reader's own options prune the listing to the second; the exact bound is applied to
    the file's time.
    """
    opts = {}
    if since:
        opts["modifiedAfter"] = (since - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
    if until:
        opts["modifiedBefore"] = (until + dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
    if glob:
        opts["pathGlobFilter"] = glob
    df = spark.read.options(**opts).text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("text")
    )
    if since:
        df = df.filter(F.col("modified") > F.lit(since).cast("timestamp"))
    return df.filter(F.col("modified") <= F.lit(until).cast("timestamp")) if until else df
