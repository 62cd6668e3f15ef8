"""Queries of the partition planning group (D)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import partition as pt
from tidemark.queries import query

SINCE, UNTIL = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 28, 12)
PLAN_SQL = """with p as (select i as "window", timestamp '2024-01-02 12:00:00' + to_days(cast(i * 3 as int)) as since,
  least(timestamp '2024-01-02 12:00:00' + to_days(cast(i * 3 + 3 as int)), timestamp '2024-01-28 12:00:00') as until
  from (select unnest(generate_series(0, 8)) i))"""


@query(
    "d01_plan_windows",
    PLAN_SQL
    + """ select "window", since, until, count(ts) as rows from p left join events on ts > since and ts <= until group by all""",
)
def d01(t):
    w = pt.plan_windows(t.spark, SINCE, UNTIL, 3, dt.timedelta(hours=12))
    n = pt.match_windows(t.events.select("ts"), "ts", w).groupBy("window").agg(F.count(F.lit(1)).alias("n"))
    return w.join(n, "window", "left").select("window", "since", "until", F.coalesce("n", F.lit(0)).alias("rows"))


@query(
    "d02_bin_contiguous",
    "select o_orderkey, ntile(7) over (order by o_orderdate, o_orderkey) - 1 as bin from orders",
)
def d02(t):
    return pt.bin_contiguous(t.orders.select("o_orderkey", "o_orderdate"), 7, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "d03_bin_weighted",
    """with c as (select o_orderkey, w, sum(w) over (order by o_orderkey) cum, sum(w) over () total
       from (select o_orderkey, case when o_orderstatus = 'F' then 1 else cast(floor(o_totalprice) as bigint) end w from orders))
       select o_orderkey, cast(least(floor((cum - w) * 8 / total), 7) as bigint) as bin from c""",
)
def d03(t):
    w = F.when(F.col("o_orderstatus") != "F", F.floor("o_totalprice").cast("bigint"))
    return pt.bin_weighted(t.orders.select("o_orderkey", w.alias("w")), 8, "w", ["o_orderkey"]).drop("w")


@query(
    "d04_bin_units",
    """select l_suppkey, l_partkey, (row_number() over (order by l_suppkey, l_partkey) - 1) % 8 as bin
       from (select distinct l_suppkey, l_partkey from lineitem)""",
)
def d04(t):
    return pt.bin_units(t.lineitem, 8, ["l_suppkey", "l_partkey"])


@query(
    "d06_plan_coverage",
    PLAN_SQL
    + """ select matches, count(*) as rows from (select event_id, count(since) as matches from events
      left join p on ts > since and ts <= until group by 1) group by 1""",
)
def d06(t):
    w = pt.plan_windows(t.spark, SINCE, UNTIL, 3, dt.timedelta(hours=12))
    return pt.coverage(t.events, "ts", "event_id", w)


@query(
    "d06_uneven_windows",
    """with p as (select * from (values (0, null::timestamp, timestamp '2024-01-05'), (1, timestamp '2024-01-05', timestamp '2024-01-05 00:00:00.000001'),
         (2, timestamp '2024-01-07', timestamp '2024-01-20'), (3, timestamp '2024-01-19 12:00:00', timestamp '2024-01-19 12:00:05'),
         (4, timestamp '2024-01-25', timestamp '2025-01-25'), (5, timestamp '2024-01-30', null), (6, timestamp '2024-01-09', timestamp '2024-01-09')) v("window", since, until))
       select matches, count(*) as rows from (select event_id, count(w) as matches from events left join (select *, 1 as w from p) p
         on (since is null or ts > since) and (until is null or ts <= until) group by 1) group by 1""",
)
def d06_uneven(t):
    at = lambda *x: dt.datetime(2024, *x)
    rows = [
        (0, None, at(1, 5)), (1, at(1, 5), at(1, 5, 0, 0, 0, 1)), (2, at(1, 7), at(1, 20)), (3, at(1, 19, 12), at(1, 19, 12, 0, 5)),
        (4, at(1, 25), dt.datetime(2025, 1, 25)), (5, at(1, 30), None), (6, at(1, 9), at(1, 9)),
    ]
    w = t.spark.createDataFrame(rows, "window bigint, since timestamp_ntz, until timestamp_ntz")
    return pt.coverage(t.events, "ts", "event_id", w)


@query(
    "d07_chunk_ids",
    """select chunk, string_agg(cast(user_id as varchar), ',' order by i) as ids, count(*) as n from
       (select user_id, i, cast(floor(i / 50.0) as bigint) chunk from (select user_id, row_number() over (order by p, user_id) - 1 i
        from (select user_id, min(event_id) p from events group by 1))) group by 1""",
)
def d07(t):
    c = pt.chunk_ids(t.events, "user_id", "event_id", 50)
    return c.select("chunk", F.array_join("ids", ",").alias("ids"), F.size("ids").cast("bigint").alias("n"))
