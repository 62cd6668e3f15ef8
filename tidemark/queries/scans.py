"""Queries of the scan and stream group (A), and the cursor operators that run as streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import cursor as cur
from tidemark.plans.meta import TableMeta
from tidemark.queries import query
from tidemark.session import scratch_dir
from tidemark.sources import files
from tidemark.streaming.apply import AppendTarget, MergeTarget
from tidemark.streaming.drain import drain
from tidemark.streaming.read import append_stream, apply_stream, dedup_stream, finish, rocksdb_state

EV = "event_id, ts, user_id, event_type, value, props"
ORD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _source(t, table: str, **kw) -> files.Landed:
    """One table of the data folder as a landed source (the folder holds other tables too)."""
    return files.Landed(t.folder, options={"pathGlobFilter": f"{table}.parquet"}, **kw)


def _landed_copy(t, df, parts: int, purpose: str) -> str:
    """The table landed as several files in the shared folder, as an upstream job leaves it."""
    path = scratch_dir(t.spark, purpose)
    df.repartition(parts).write.parquet(path)
    return path


@query("a01_read_batch", f"select {ORD} from orders")
def a01(t):
    meta = TableMeta(["o_orderkey"], "o_orderdate", "cdc")
    return files.read_batch(t.spark, _source(t, "orders", meta=meta))


@query("a01_read_batch_json", "select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders")
def a01_json(t):
    cols = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    path = scratch_dir(t.spark, "json")
    df = t.orders.select(*cols)
    df.select(F.to_json(F.struct(*cols)).alias("value")).write.text(path)
    return files.read_batch(t.spark, files.Landed(path, schema=df.schema, format="json"))


@query("a02_read_stream", f"select {EV} from events")
def a02(t):
    src = files.Landed(_landed_copy(t, t.events, 6, "a02-in"))
    out, ck = scratch_dir(t.spark, "a02-out"), scratch_dir(t.spark, "a02-ck")
    finish(append_stream(files.read_stream(t.spark, src, 2), out, ck))
    return t.spark.read.parquet(out)


@query(
    "a03_landed_stream",
    """select event_id, case when event_type <> 'error' then ts end as ts, user_id from events
       union all select -user_id, max(ts) over (), user_id from (select distinct user_id from events), (select max(ts) as ts from events)""",
)
def a03(t):
    # some rows have no cursor; after the first sitting more rows arrive whose cursor is the greatest one already read
    df = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"), "user_id")
    path = _landed_copy(t, df, 4, "a03-in")
    src = files.Landed(path, TableMeta(["event_id"], "ts", "cdc"), df.schema)
    out, ck = scratch_dir(t.spark, "a03-out"), scratch_dir(t.spark, "a03-ck")
    finish(append_stream(files.read_cursor_stream(t.spark, src, files_per_trigger=2), out, ck))
    newest = t.events.agg(F.max("ts")).scalar()
    late = t.events.select("user_id").distinct().select((-F.col("user_id")).alias("event_id"), newest.alias("ts"), "user_id")
    late.write.mode("append").parquet(path)
    finish(append_stream(files.read_cursor_stream(t.spark, src, files_per_trigger=2), out, ck))
    return t.spark.read.parquet(out)


@query(
    "a04_partitioned_batch",
    "select o_orderkey, o_orderdate from orders where o_orderdate > timestamp '1996-12-31' and o_orderdate <= timestamp '1998-12-31'",
)
def a04(t):
    meta = TableMeta(["o_orderkey"], "o_orderdate", "cdc")
    df = files.read_partitioned(t.spark, _source(t, "orders", meta=meta), dt.datetime(1996, 12, 31), dt.datetime(1998, 12, 31))
    return df.select("o_orderkey", "o_orderdate")


@query("a05_delete_stream", "select o_orderkey, o_orderdate, true as _deleted from orders where o_orderstatus = 'F'")
def a05(t):
    gone = _landed_copy(t, t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"), 3, "a05-in")
    meta = TableMeta(["o_orderkey"], "o_orderdate", "cdc_with_deletes")
    src = files.Landed(t.path("orders"), meta, t.orders.schema, deletes=gone)
    out, ck = scratch_dir(t.spark, "a05-out"), scratch_dir(t.spark, "a05-ck")
    finish(append_stream(files.read_delete_stream(t.spark, src), out, ck))
    return t.spark.read.parquet(out)


@query("a06_read_between", f"select {EV} from events where ts > timestamp '2024-01-08' and ts <= timestamp '2024-01-15'")
def a06(t):
    return files.read_between(t.events, "ts", dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15))


@query("a07_read_ndjson", "select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P'")
def a07(t):
    rec = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    line = F.when(F.col("o_orderstatus") == "F", rec).when(F.col("o_orderstatus") == "O", F.concat(F.lit('{"events":['), rec, F.lit("]}"))).otherwise(
        F.lit('{"o_orderkey": broken')
    )
    path = scratch_dir(t.spark, "ndjson")
    t.orders.select(line.alias("value")).write.option("compression", "gzip").text(path)
    records, _ = files.read_ndjson(t.spark, path)
    return records.select(
        F.get_json_object("record", "$.o_orderkey").cast("bigint").alias("o_orderkey"), F.get_json_object("record", "$.o_orderstatus").alias("o_orderstatus")
    )


@query("a08_read_csv_report", "select o_orderkey as order_key, nullif(o_orderstatus, 'F') as order_status, o_orderpriority as priority from orders")
def a08(t):
    path = scratch_dir(t.spark, "csv")
    status = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    t.orders.select(
        F.col("o_orderkey").alias("﻿Order Key"), status.alias("Order Status"), F.col("o_orderpriority").alias("Priority")
    ).write.option("header", "true").csv(path)
    return files.read_csv_report(t.spark, path).withColumn("order_key", F.col("order_key").cast("bigint"))


@query("a09_files_modified", "select doc_id, n_chars from documents")
def a09(t):
    path = scratch_dir(t.spark, "mtime")
    t.documents.select(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("n_chars").cast("string")).alias("value")).write.text(path)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    raw = files.read_files_modified(t.spark, path, now - dt.timedelta(hours=1), now + dt.timedelta(hours=1), "*.txt")
    lines = raw.select(F.explode(F.split(F.rtrim(F.regexp_replace("text", "\\n$", "")), "\\n")).alias("l"))
    cut = F.split("l", "\\|")
    return lines.select(cut[0].cast("bigint").alias("doc_id"), cut[1].cast("bigint").alias("n_chars"))


@query("c01_append", f"select {EV} from events")
def c01(t):
    # the second half of the landed files is delivered twice, as a read with lookback does
    path = _landed_copy(t, t.events, 3, "c01-in")
    t.events.filter("ts > timestamp_ntz '2024-01-15'").repartition(3).write.mode("append").parquet(path)
    target = AppendTarget(t.spark, scratch_dir(t.spark, "c01"), t.events.schema, ["event_id"])
    stream = files.read_stream(t.spark, files.Landed(path), 2)
    finish(apply_stream(stream, target, scratch_dir(t.spark, "c01-ck")))
    return target.read()


@query("c13_streaming_dedup", "select event_id, user_id, cast(epoch_us(ts) as bigint) as us from events")
def c13_streaming(t):
    # everything is delivered, then the second half again, after a restart
    rows = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    path, out, ck = (scratch_dir(t.spark, f"c13-{x}") for x in ("in", "out", "ck"))
    rocksdb_state(t.spark)
    for part in (rows, rows.filter("ts > timestamp '2024-01-15'")):
        part.repartition(3).write.mode("append").parquet(path)
        stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
        finish(append_stream(dedup_stream(stream, ["event_id"], "ts", "40 days"), out, ck))
    return t.spark.read.parquet(out).select("event_id", "user_id", F.unix_micros("ts").alias("us"))


SEQ = "(datediff('day', timestamp '1970-01-01', o_orderdate) * 1000000000 + o_orderkey)"


def _changes(t):
    seq = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 1_000_000_000 + F.col("o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice", seq.alias("seq"), (F.col("o_orderstatus") == "F").alias("__deleted"))


def _merged(t, scd_type: int):
    df = _changes(t)
    src = files.Landed(_landed_copy(t, df, 6, "merge-in"))
    target = MergeTarget(t.spark, scratch_dir(t.spark, "merge"), df.schema, ["o_custkey"], "seq", scd_type)
    ck = scratch_dir(t.spark, "merge-ck")
    finish(apply_stream(files.read_stream(t.spark, src, 3), target, ck))
    target.compact()
    # a quarter of the changes is delivered again after the compaction
    df.filter("o_custkey % 4 = 0").write.mode("append").parquet(src.path)
    finish(apply_stream(files.read_stream(t.spark, src, 3), target, ck))
    return target.read()


@query(
    "c03_streaming_scd1",
    f"""select o_custkey, o_orderkey, o_totalprice, seq from (select *, {SEQ} as seq from orders
        qualify row_number() over (partition by o_custkey order by {SEQ} desc) = 1) where o_orderstatus <> 'F'""",
)
def c03_stream(t):
    return _merged(t, 1)


@query(
    "c05_streaming_scd2",
    f"""select o_custkey, o_orderkey, o_totalprice, seq, seq as __START_AT, e as __END_AT from
        (select *, lead(seq) over (partition by o_custkey order by seq) e from (select *, {SEQ} as seq from orders)) where o_orderstatus <> 'F'""",
)
def c05_stream(t):
    return _merged(t, 2)


@query("b33_drain", "select o_orderkey, o_orderdate from orders where o_orderdate > timestamp '1994-12-31'")
def b33(t):
    df = t.orders.select("o_orderkey", "o_orderdate")
    out = scratch_dir(t.spark, "drain")
    init, step = dt.datetime(2001, 12, 31), dt.timedelta(days=730)

    def read(offset):
        rows, end = cur.window_slice(df, "o_orderdate", offset["cursor"], step, init)
        if end == offset["cursor"]:
            return offset
        rows.write.mode("append").parquet(out)
        return {"cursor": end}

    drain(read, {"cursor": dt.datetime(1994, 12, 31)})
    return t.spark.read.parquet(out)


@query("b34_two_part_offset", "select o_orderkey, o_orderdate from orders")
def b34(t):
    df = t.orders.select("o_orderkey", "o_orderdate")
    # a walk in two sittings: the first stops in the middle, the second resumes there
    half = df.filter(F.col("o_orderdate") <= F.lit(dt.datetime(1998, 1, 1)))
    last = half.agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("x")).first()["x"]
    state = cur.two_part_offset(None, None, (last["o_orderdate"], last["o_orderkey"]), False)
    rest = cur.keyset_resume(df, "o_orderdate", "o_orderkey", *state["resume"])
    return half.unionByName(rest)
