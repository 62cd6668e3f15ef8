"""Queries of the report group (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import reports as rp
from tidemark.queries import query
from tidemark.session import checkpointed, scratch_dir
from tidemark.sources import files
from tidemark.streaming.read import append_stream, finish

GAP = 6 * 3600
SESS = """with e as (select user_id, ts, event_id, lag(ts) over (partition by user_id order by ts, event_id) p from events),
  f as (select *, sum(case when p is null or epoch_us(ts) - epoch_us(p) >= 21600000000 then 1 else 0 end) over (partition by user_id order by ts, event_id) sid from e),
  s as (select user_id, sid, min(ts) as "start", max(ts) as "end", (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 as seconds, count(*) as events from f group by 1, 2)"""


@query(
    "n01_report",
    """select cast(o_orderdate as date) as date, o_orderpriority, count(*) as orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue
       from orders where o_orderstatus <> 'P' and o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01'
       group by 1, 2 having count(*) > 1""",
)
def n01(t):
    df = t.orders.withColumn("date", F.to_date("o_orderdate"))
    return rp.report(
        df, ["date", "o_orderpriority"],
        {"orders": F.count(F.lit(1)), "revenue": F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")},
        "o_orderstatus <> 'P' and o_orderdate >= timestamp_ntz '1998-01-01' and o_orderdate < timestamp_ntz '1999-01-01'",
        "orders > 1", ["date", "o_orderpriority"],
    )


@query(
    "n02_active_users",
    """select cast(ts as date) as date, event_type as segment, count(distinct user_id) as count from events group by 1, 2
       union all select cast(ts as date), 'Totals', count(distinct user_id) from events group by 1""",
)
def n02(t):
    e = t.events
    return rp.active_users(e, "user_id", "ts", "event_type").unionByName(rp.active_users(e, "user_id", "ts"))


@query(
    "n02_active_users_bitmaps",
    " union all ".join(
        f"select '{u}' as unit, cast(date_trunc('{u}', ts) as date) as date, event_type as segment, count(distinct user_id) as count from events group by 2, 3"
        for u in ("day", "week", "month")
    ),
)
def n02_bitmaps(t):
    numbers = rp.dense_ids(t.events, "user_id")
    stored = checkpointed(rp.daily_bitmaps(t.events.join(numbers, "user_id"), "user_no", "ts", "event_type"), "n02")
    parts = [rp.active_users_of(stored, u).select(F.lit(u).alias("unit"), "date", "segment", "count") for u in ("day", "week", "month")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("n03_sessions", SESS + ' select user_id, "start", "end", seconds, events from s')
def n03_sessions(t):
    return rp.sessions(t.events, "user_id", "ts", GAP)


@query("n03_streaming_sessions", SESS + ' select user_id, "start", "end", events from s')
def n03_streaming(t):
    # two sittings: all events, then one far in the future, which moves the watermark past every session
    df = t.events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    path, out, ck = (scratch_dir(t.spark, f"n03-{x}") for x in ("in", "out", "ck"))
    df.repartition(4).write.parquet(path)
    for _ in range(2):
        stream = files.read_stream(t.spark, files.Landed(path, schema=df.schema), 2)
        finish(append_stream(rp.streaming_sessions(stream, "user_id", "ts", f"{GAP} seconds", "60 days"), out, ck))
        df.limit(1).select(F.lit(-1).cast("bigint").alias("user_id"), (F.col("ts") + F.expr("interval 1000 days")).alias("ts")).write.mode("append").parquet(path)
    done = t.spark.read.parquet(out).filter("user_id >= 0")
    return done.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "events")


@query("n03_avg_session_length", SESS + ' select cast("start" as date) as date, round(avg(seconds), 4) as length from s group by 1')
def n03(t):
    return rp.avg_session_length(t.events, "user_id", "ts", GAP).withColumn("length", F.round("length", 4))


@query(
    "n04_session_length_distribution",
    SESS + """ select case when seconds >= 36000 then '>=36000' when seconds >= 3600 then '3600-36000' when seconds >= 600 then '600-3600' else '<600' end as bucket,
      count(*) as count from s group by 1""",
)
def n04(t):
    return rp.session_length_distribution(t.events, "user_id", "ts", GAP, [600, 3600, 36000])


@query(
    "n05_sessions_per_user",
    SESS + """ select cast("start" as date) as date, round(count(*) / count(distinct user_id), 6) as avg_sessions from s group by 1""",
)
def n05(t):
    return rp.sessions_per_user(t.events, "user_id", "ts", GAP).withColumn("avg_sessions", F.round("avg_sessions", 6))


@query("n06_events_list", "select event_type, count(*) as totals from events group by 1")
def n06(t):
    return rp.events_list(t.events, "event_type")


@query("n07_cohort", "select distinct user_id from events where event_type = 'purchase' and value > 100")
def n07(t):
    return rp.cohort(t.events, "user_id", "event_type = 'purchase' and value > 100")


@query(
    "n07_cohort_sizes",
    """select 'buyers' as cohort, count(distinct user_id) as count from events where event_type = 'purchase'
       union all select 'big', count(distinct user_id) from events where value > 200""",
)
def n07_sizes(t):
    return rp.cohort_sizes(t.events, "user_id", {"buyers": "event_type = 'purchase'", "big": "value > 200"})


@query(
    "n08_survey_rollups",
    """select 'status' as question, o_orderstatus as choice, count(*) as count from orders where o_orderstatus <> 'P' group by 2
       union all select 'priority', o_orderpriority, count(*) from orders group by 2""",
)
def n08(t):
    m = F.create_map(F.lit("status"), F.nullif("o_orderstatus", F.lit("P")), F.lit("priority"), F.col("o_orderpriority"))
    return rp.survey_rollups(t.orders.select(m.alias("a")), "a")


@query(
    "n09_app_reports",
    """select case when user_id < 10 then 'organic_' else '' end || case event_type when 'signup' then 'installs_report' when 'purchase' then 'in_app_events_report'
         else 'uninstall_events_report' end as report, cast(ts as date) as date, count(*) as events from events
       where event_type in ('signup', 'purchase', 'error') group by 1, 2""",
)
def n09(t):
    kinds = {"signup": "installs_report", "purchase": "in_app_events_report", "error": "uninstall_events_report"}
    return rp.app_reports(t.events, "event_type", kinds, F.col("user_id") < 10, "ts")


@query("n10_active_profiles", "select user_id, ts, event_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def n10(t):
    return rp.active_profiles(t.events.select("user_id", "ts", "event_id", "event_type", "value"), "user_id", ["ts", "event_id"])
