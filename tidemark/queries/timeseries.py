"""Queries of the time series group (J): events as samples, the event type as tag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import timeseries as ts
from tidemark.queries import query

S, E = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 29)
SAMPLES = "with s as (select event_type as tag, ts, value from events)"


def _samples(t):
    return t.events.select(F.col("event_type").alias("tag"), "ts", "value")


def _points(t):
    """Query times: order days of 2024 do not exist, so ten minutes after each event of all tags."""
    return t.events.select(F.col("event_type").alias("tag"), (F.col("ts") + F.expr("interval 10 minutes")).alias("ts"))


@query(
    "j01_recorded",
    SAMPLES + """ select tag, ts, value from s where tag in ('view', 'click') and ts >= timestamp '2024-01-02' and ts <= timestamp '2024-01-29'
      qualify row_number() over (partition by tag order by ts) <= 1000""",
)
def j01(t):
    return ts.recorded(_samples(t), ["view", "click"], S, E, 1000)


GRID = SAMPLES + """, g as (select tag, unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-31', interval 30 minute)) as ts from (select distinct tag from s)),
  b as (select g.tag, g.ts, l.ts lt, l.value lv, n.ts nt, n.value nv from g asof left join s l on l.tag = g.tag and g.ts >= l.ts
        asof left join s n on n.tag = g.tag and g.ts < n.ts)
  select tag, ts, round(case when lt is null then null when lt = ts or nt is null then lv
    else lv + (nv - lv) * ((epoch_us(ts) - epoch_us(lt)) / (epoch_us(nt) - epoch_us(lt))) end, 6) as value from b"""


@query("j02_interpolated", GRID)
def j02(t):
    out = ts.interpolated(_samples(t), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31), dt.timedelta(minutes=30))
    return out.withColumn("value", F.round("value", 6))


POINTS = SAMPLES + ", g as (select distinct tag, ts + interval 10 minute as ts from s)"


@query(
    "j03_value_at",
    POINTS + """, b as (select g.tag, g.ts, l.ts lt, l.value lv, n.ts nt, n.value nv from g asof left join s l on l.tag = g.tag and g.ts >= l.ts
        asof left join s n on n.tag = g.tag and g.ts < n.ts)
      select tag, ts, round(case when lt = ts or nt is null then lv else lv + (nv - lv) * ((epoch_us(ts) - epoch_us(lt)) / (epoch_us(nt) - epoch_us(lt))) end, 6) as value from b""",
)
def j03(t):
    return ts.value_at(_samples(t), _points(t)).withColumn("value", F.round("value", 6))


@query(
    "j04_recorded_at",
    POINTS + " select g.tag, g.ts, l.ts as sample_ts, l.value from g asof left join s l on l.tag = g.tag and g.ts >= l.ts",
)
def j04(t):
    return ts.recorded_at(_samples(t), _points(t))


@query("j05_current_value", SAMPLES + " select tag, ts, value from s qualify row_number() over (partition by tag order by ts desc) = 1")
def j05(t):
    return ts.current_value(_samples(t))


@query(
    "j06_end_value",
    SAMPLES + " select tag, ts, value from s where ts >= timestamp '2024-01-02' and ts <= timestamp '2024-01-29' qualify row_number() over (partition by tag order by ts desc) = 1",
)
def j06(t):
    return ts.end_value(_samples(t), S, E)


@query(
    "j07_plot",
    SAMPLES + """, u as (select * from s where ts <> timestamp '2024-01-29' union all select distinct tag, timestamp '2024-01-29', 123.0 from s),
      b as (select *, least((epoch_us(ts) - epoch_us(timestamp '2024-01-02')) // 46656000000, 49) as b, value < 400 as good from u
        where ts >= timestamp '2024-01-02' and ts <= timestamp '2024-01-29'),
      r as (select *, row_number() over (partition by tag, b order by ts) a1, row_number() over (partition by tag, b order by ts desc) a2,
        row_number() over (partition by tag, b order by value, ts) a3, row_number() over (partition by tag, b order by value desc, ts desc) a4,
        row_number() over (partition by tag, b, good order by ts) a5 from b)
      select tag, ts, value from r where a1 = 1 or a2 = 1 or a3 = 1 or a4 = 1 or (not good and a5 = 1)""",
)
def j07(t):
    at_end = _samples(t).select("tag").distinct().select("tag", F.lit(E).cast("timestamp_ntz").alias("ts"), F.lit(123.0).alias("value"))
    df = _samples(t).filter(F.col("ts") != F.lit(E)).unionByName(at_end).withColumn("good", F.col("value") < 400)
    return ts.plot(df, S, E, 50, good="good")


@query(
    "j08_summary_event_weighted",
    SAMPLES + """, b as (select *, (epoch_us(ts) - epoch_us(timestamp '2024-01-02')) // 259200000000 as b, case when value < 400 then value end as v from s
        where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-29'),
      a as (select tag, timestamp '2024-01-02' + to_days(cast(b * 3 as int)) as ts, sum(v) as "Total", avg(v) as "Average", min(v) as "Minimum", max(v) as "Maximum",
        max(v) - min(v) as "Range", stddev_samp(v) as "StdDev", stddev_pop(v) as "PopulationStdDev", cast(count(v) as double) as "Count", 100.0 * count(v) / count(*) as "PercentGood" from b group by 1, 2)
      select tag, ts, type, round(value, 4) as value from a unpivot (value for type in ("Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "PopulationStdDev", "Count", "PercentGood"))""",
)
def j08(t):
    df = _samples(t).withColumn("good", F.col("value") < 400)
    out = ts.summary(df, S, E, duration=dt.timedelta(days=3), good="good")
    return out.withColumn("value", F.round("value", 4))


@query(
    "j08_summary_time_weighted",
    SAMPLES + """, u as (select tag, ts, value, 1 as own from s where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-29'
        union all select tag, timestamp '2024-01-02', arg_max(value, ts), 0 from s where ts < timestamp '2024-01-02' group by tag),
      d as (select tag, value v, epoch_us(ts) - epoch_us(timestamp '2024-01-02') lo,
        coalesce(lead(epoch_us(ts)) over (partition by tag order by ts, own), epoch_us(timestamp '2024-01-29')) - epoch_us(timestamp '2024-01-02') hi from u),
      p as (select tag, v, b, (least(hi, (b + 1) * 86400000000) - greatest(lo, b * 86400000000)) / 1000000.0 w from
        (select *, unnest(generate_series(lo // 86400000000, (hi - 1) // 86400000000)) b from d where hi > lo)),
      a as (select tag, timestamp '2024-01-02' + to_days(cast(b as int)) as ts, sum(w * v) / 86400 as "Total", sum(w * v) / sum(w) as "Average",
        min(v) as "Minimum", max(v) as "Maximum", sum(w) as "Count" from p group by 1, 2)
      select tag, ts, type, round(value, 4) as value from a unpivot (value for type in ("Total", "Average", "Minimum", "Maximum", "Count"))""",
)
def j08_time(t):
    types = ["Total", "Average", "Minimum", "Maximum", "Count"]
    out = ts.summary(_samples(t), S, E, types, "TimeWeighted", dt.timedelta(days=1))
    return out.withColumn("value", F.round("value", 4))


@query(
    "j09_calculated",
    SAMPLES + """ select tag, timestamp '2024-01-02' + to_hours(cast(((epoch_us(ts) - epoch_us(timestamp '2024-01-02')) // 21600000000) * 6 as int)) as ts,
      round(avg(value), 6) as value, 'Average' as calculation_type from s where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-29' group by 1, 2""",
)
def j09(t):
    return ts.calculated(_samples(t), S, E, dt.timedelta(hours=6)).withColumn("value", F.round("value", 6))


def frames(t):
    """Errors and purchases as frames: as many minutes long as their value; big ones are open."""
    end = F.when(
        F.col("value") < 150,
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("value") * 60).cast("bigint") * 1_000_000).cast("timestamp_ntz"),
    )
    return t.events.filter("event_type in ('error', 'purchase')").select(
        F.col("event_id").alias("frame_id"), F.col("event_type").alias("tag"), F.col("ts").alias("start_time"), end.alias("end_time"), "user_id"
    )


FRAMES = """with f as (select event_id as frame_id, event_type as tag, ts as start_time, user_id,
  case when value < 150 then ts + to_seconds(cast(round(value * 60) as bigint)) end as end_time from events where event_type in ('error', 'purchase'))"""


@query(
    "j11_event_frames",
    FRAMES + " select frame_id, tag, start_time, end_time, user_id from f where start_time <= timestamp '2024-01-20' and coalesce(end_time, timestamp '9999-01-01') >= timestamp '2024-01-10'",
)
def j11(t):
    return ts.event_frames(frames(t), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))


@query(
    "j11_frame_samples",
    FRAMES + """ select frame_id, count(*) as samples, max(e.ts) as last_sample from f join events e on e.event_type = f.tag
      and e.ts >= start_time and e.ts < coalesce(end_time, start_time + interval 1 day) group by 1""",
)
def j11_samples(t):
    fr = frames(t).withColumn("end_time", F.coalesce("end_time", F.col("start_time") + F.expr("interval 1 day")))
    out = ts.frame_statistics(fr.drop("user_id"), _samples(t), dt.datetime(2024, 2, 2))
    return out.filter("samples > 0").select("frame_id", "samples", "last_sample")


@query(
    "j11_frame_pairs",
    FRAMES + """ select frame_id, count(*) as samples, min(e.ts) as first_sample, max(e.ts) as last_sample, cast(sum(epoch_us(e.ts) % 1000003) as bigint) as mark
      from f join events e on e.event_type = f.tag and e.ts >= start_time and e.ts < coalesce(end_time, timestamp '2024-02-02') group by 1""",
)
def j11_pairs(t):
    samples = _samples(t).withColumn("mark", F.unix_micros(F.col("ts").cast("timestamp")) % 1000003)
    pairs = ts.frame_samples(frames(t).drop("user_id"), samples, dt.datetime(2024, 2, 2))
    return pairs.groupBy("frame_id").agg(
        F.count(F.lit(1)).alias("samples"), F.min("ts").alias("first_sample"), F.max("ts").alias("last_sample"), F.sum("mark").alias("mark")
    )


@query(
    "j12_frame_elements",
    FRAMES + """ select frame_id, 'tag:' || tag as element, start_time as cursor from f
      union all select frame_id, 'user:' || user_id, start_time from f where end_time is not null""",
)
def j12(t):
    user = F.when(F.col("end_time").isNotNull(), F.concat(F.lit("user:"), F.col("user_id").cast("string")))
    el = F.array_compact(F.array(F.concat(F.lit("tag:"), F.col("tag")), user))
    return ts.frame_elements(frames(t).withColumn("el", el), "el", "frame_id")


@query(
    "j13_point_catalog",
    """select case when p_name = 'red widget' then 'Unknown' else split_part(p_name, ' ', 1) end as type, p_brand as unit, count(*) as count from part group by 1, 2""",
)
def j13(t):
    blank = F.when(F.col("p_name") == "red widget", " ").otherwise(F.col("p_name"))
    return ts.point_catalog(t.part.select(blank.alias("d"), "p_brand"), "d", "p_brand")


@query("j14_dedupe_page_overlap", "select event_type as tag, ts, value from events")
def j14(t):
    page1 = _samples(t).filter("ts <= timestamp_ntz '2024-01-20'")
    page2 = _samples(t).filter("ts >= timestamp_ntz '2024-01-10'")
    return ts.dedupe_page_overlap(page1.unionByName(page2))
