"""Queries of the whole-ingestion group (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.ingest import ingest
from tidemark.plans.meta import TableMeta
from tidemark.queries import query
from tidemark.session import scratch_dir
from tidemark.sources.files import Landed

SPEC = {
    "connection_name": "shop",
    "objects": [
        {"table": {"source_table": "orders", "table_configuration": {"scd_type": "scd_type_1", "files_per_trigger": 2}}},
        {"table": {"source_table": "customer", "destination_table": "customers"}},
        {"table": {"source_table": "events", "table_configuration": {"scd_type": "APPEND_ONLY"}}},
        {"table": {"source_table": "profiles", "table_configuration": {"scd_type": "SCD_TYPE_2", "primary_keys": ["user_id"], "sequence_by": "event_id"}}},
    ],
}


def run(t):
    """Orders with a delete flow, customers as snapshot, events appended, profiles as type 2."""
    s = t.spark

    def land(df, name):
        path = scratch_dir(s, f"land-{name}")
        df.repartition(4).write.parquet(path)
        return path

    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    gone = land(o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"), "deletes")
    prof = t.events.select("user_id", "event_type", "event_id")
    ev = t.events.select("event_id", "ts", "user_id")
    cu = t.customer.select("c_custkey", "c_name")
    sources = {
        "orders": Landed(land(o, "orders"), TableMeta(["o_orderkey"], "o_orderdate", "cdc_with_deletes"), o.schema, deletes=gone),
        "customer": Landed(land(cu, "customer"), TableMeta(["c_custkey"], None, "snapshot"), cu.schema),
        "events": Landed(land(ev, "events"), TableMeta(["event_id"], "ts", "cdc"), ev.schema),
        "profiles": Landed(land(prof, "profiles"), TableMeta([], "event_id", "cdc"), prof.schema),
    }
    return ingest(s, SPEC, sources, scratch_dir(s, "ingest"))


@query(
    "l01_ingest",
    """select 'orders' as target, count(*) as rows, cast(sum(o_orderkey) as bigint) as checksum from orders where o_orderstatus <> 'F'
       union all select 'customers', count(*), cast(sum(c_custkey) as bigint) from customer
       union all select 'events', count(*), cast(sum(event_id) as bigint) from events
       union all select 'profiles', count(*), cast(sum(coalesce(e, 0)) as bigint) from (select lead(event_id) over (partition by user_id order by event_id) e from events)""",
)
def l01(t):
    done = run(t)

    def line(table, name, value):
        return done.read(table).agg(F.lit(name).alias("target"), F.count(F.lit(1)).alias("rows"), F.sum(value).alias("checksum"))

    return (
        line("orders", "orders", F.col("o_orderkey")).unionByName(line("customer", "customers", F.col("c_custkey")))
        .unionByName(line("events", "events", F.col("event_id"))).unionByName(line("profiles", "profiles", F.coalesce("__END_AT", F.lit(0))))
    )


@query(
    "l05_multi_table_history",
    """select user_id, event_type, event_id, event_id as __START_AT, lead(event_id) over (partition by user_id order by event_id) as __END_AT from events""",
)
def l05(t):
    return run(t).read("profiles")
