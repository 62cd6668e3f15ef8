"""Time series of (tag, ts, value, quality flags): resampling, lookups and summaries.

Interpolation is linear between samples, exact at a sample, null before the first one and
held after the last. Time-weighted statistics hold each value until the next sample. A pair
(tag, ts) is unique (see ``dedupe_page_overlap``). Tags are non-null. All per-tag ordering
goes through ``ordered``, so one tag may hold most of the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ordered
from tidemark.operators.intervals import explode_range, points_in_many

SUMMARY_TYPES = [
    "Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "PopulationStdDev", "Count", "PercentGood",
]


def _us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _lit_us(t: dt.datetime) -> Column:
    return F.unix_micros(F.lit(t).cast("timestamp"))


def _width(d: dt.timedelta) -> int:
    return d // dt.timedelta(microseconds=1)


def time_range(end: dt.datetime | None, start: dt.datetime | None, offset: dt.datetime | None, init: dt.datetime, lookback_minutes: int = 60, window_seconds: int | None = None):
    """(start, end) of a read: the stored offset, else the option, else the look-back before the end.

    Both are capped at ``init``; a window moves the end closer to the start.
    """
    stop = min(end or init, init)
    begin = offset or start or stop - dt.timedelta(minutes=lookback_minutes)
    if window_seconds:
        stop = min(stop, begin + dt.timedelta(seconds=window_seconds))
    return min(begin, init), stop


def recorded(df: DataFrame, tags: list[str], start, end, max_count: int, tag: str = "tag", ts: str = "ts") -> DataFrame:
    """Raw samples of the tags in ``[start, end]``, the first ``max_count`` of each tag."""
    d = df.filter(F.col(tag).isin(tags) & (F.col(ts) >= F.lit(start)) & (F.col(ts) <= F.lit(end)))
    return ordered.row_index(d, [tag], [ts], "__i").filter(F.col("__i") < max_count).drop("__i")


GRID_BLOCK = 10_000


def grid(df: DataFrame, start: dt.datetime, end: dt.datetime, interval: dt.timedelta, tag: str = "tag", ts: str = "ts") -> DataFrame:
    """Every (tag, grid point); the number of points is fixed by the interval.

    The grid is made in blocks that are spread over the cluster before they are filled,
    so neither one row nor one task holds all points of a tag.
    """
    step = F.make_dt_interval(secs=F.lit(interval.total_seconds()))
    tags = df.select(tag).distinct()
    block = interval * GRID_BLOCK
    starts = F.sequence(F.lit(start), F.lit(end), F.make_dt_interval(secs=F.lit(block.total_seconds())))
    blocks = tags.select(tag, F.explode(starts).alias("__from")).repartition(tag, "__from")
    stop = F.least(F.col("__from") + F.make_dt_interval(secs=F.lit((block - interval).total_seconds())), F.lit(end))
    return blocks.select(tag, F.explode(F.sequence(F.col("__from"), stop, step)).alias(ts))


def _around(samples: DataFrame, points: DataFrame, tag: str, ts: str, value: str) -> DataFrame:
    """Query points with the sample at or before (``__l``) and after (``__n``) each."""
    s = samples.filter(F.col(value).isNotNull()).select(
        tag, ts, F.lit(0).alias("__kind"), F.struct(F.col(ts).alias("t"), F.col(value).alias("v")).alias("__s")
    )
    p = points.select(tag, ts, F.lit(1).alias("__kind")).distinct()
    both = s.unionByName(p, allowMissingColumns=True)
    filled = ordered.fill_value(both, [tag], [ts, "__kind"], "__s", "__l", "__n")
    return filled.filter("__kind = 1").drop("__kind", "__s")


def value_at(samples: DataFrame, points: DataFrame, tag: str = "tag", ts: str = "ts", value: str = "value") -> DataFrame:
    """Interpolated value at each (tag, ts) of ``points``."""
    d = _around(samples, points, tag, ts, value)
    lt, lv, nt, nv = F.col("__l.t"), F.col("__l.v"), F.col("__n.t"), F.col("__n.v")
    share = (_us(F.col(ts)) - _us(lt)) / (_us(nt) - _us(lt))
    linear = lv + (nv - lv) * share
    v = F.when(lt.isNull(), F.lit(None)).when((lt == F.col(ts)) | nt.isNull(), lv).otherwise(linear)
    return d.select(tag, ts, v.alias(value))


def interpolated(df: DataFrame, start: dt.datetime, end: dt.datetime, interval: dt.timedelta, tag: str = "tag", ts: str = "ts", value: str = "value") -> DataFrame:
    """Value of every tag at every grid point."""
    return value_at(df, grid(df, start, end, interval, tag, ts), tag, ts, value)


def recorded_at(samples: DataFrame, points: DataFrame, tag: str = "tag", ts: str = "ts", value: str = "value") -> DataFrame:
    """Last recorded sample at or before each point: (tag, ts, sample_ts, value)."""
    d = _around(samples, points, tag, ts, value)
    return d.select(tag, ts, F.col("__l.t").alias("sample_ts"), F.col("__l.v").alias(value))


def current_value(df: DataFrame, tag: str = "tag", ts: str = "ts", until=None) -> DataFrame:
    """Latest sample of every tag, at or before ``until`` if given."""
    if until is not None:
        df = df.filter(F.col(ts) <= F.lit(until))
    rest = [c for c in df.columns if c != tag]
    last = df.groupBy(tag).agg(F.max_by(F.struct(*rest), ts).alias("__r"))
    return last.select(*[F.col(c) if c == tag else F.col("__r")[c].alias(c) for c in df.columns])


def end_value(df: DataFrame, start, end, tag: str = "tag", ts: str = "ts") -> DataFrame:
    """Last recorded sample of every tag within ``[start, end]``."""
    return current_value(df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) <= F.lit(end))), tag, ts)


def _bucket(ts: Column, start: dt.datetime, width: int) -> Column:
    return F.floor((_us(ts) - _lit_us(start)) / F.lit(width)).cast("bigint")


def bucket_start(bucket: Column, start: dt.datetime, width: int, kind: str) -> Column:
    return F.timestamp_micros(_lit_us(start) + bucket * width).cast(kind)


def plot(df: DataFrame, start: dt.datetime, end: dt.datetime, intervals: int = 300, tag: str = "tag", ts: str = "ts", value: str = "value", good: str | None = None) -> DataFrame:
    """Per tag and interval the first, last, lowest, highest and first bad sample of ``[start, end]``: the points
    that matter for drawing, at most five. A sample at ``end`` belongs to the last interval."""
    width = -(-_width(end - start) // intervals)
    d = df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) <= F.lit(end))).select(
        tag, F.least(_bucket(F.col(ts), start, width), F.lit(intervals - 1).cast("bigint")).alias("__b"), F.struct(F.col(ts).alias("t"), F.col(value).alias("v")).alias("__s"),
        *([F.col(good).alias("__good")] if good else []),
    )
    t, v = F.col("__s.t"), F.col("__s.v")
    picks = [F.min_by("__s", t), F.max_by("__s", t), F.min_by("__s", F.when(v.isNotNull(), F.struct(v, t))), F.max_by("__s", F.when(v.isNotNull(), F.struct(v, t)))]
    if good:
        picks.append(F.min_by("__s", F.when(~F.col("__good"), t)))
    per = d.groupBy(tag, "__b").agg(F.array(*picks).alias("__p"))
    out = per.select(tag, F.explode(F.array_distinct(F.array_compact("__p"))).alias("__s"))
    return out.select(tag, t.alias(ts), v.alias(value))


def _statistics(weight: Column, v: Column, good: Column, total: Column, count: Column) -> dict[str, Column]:
    ok = good & v.isNotNull()
    w, x = F.when(ok, weight), F.when(ok, v)
    mean = F.sum(w * x) / F.sum(w)
    var = F.sum(w * x * x) / F.sum(w) - mean * mean
    return {
        "Total": total, "Average": mean, "Minimum": F.min(x), "Maximum": F.max(x), "Range": F.max(x) - F.min(x),
        "PopulationStdDev": F.sqrt(F.greatest(var, F.lit(0.0))), "Count": count,
        "PercentGood": F.coalesce(F.sum(w), F.lit(0.0)) / F.sum(weight) * 100,
    }


def summary(
    df: DataFrame, start: dt.datetime, end: dt.datetime, types: list[str] = SUMMARY_TYPES, basis: str = "EventWeighted",
    duration: dt.timedelta | None = None, tag: str = "tag", ts: str = "ts", value: str = "value", good: str | None = None,
) -> DataFrame:
    """(tag, ts, type, value) per bucket of ``duration``, or one bucket for the whole range.

    ``TimeWeighted`` holds each value until the next sample (the last until ``end``), the last one before
    ``start`` from ``start`` on, and cuts the pieces at the bucket borders; Total is the integral over days, Count the seconds.
    """
    if basis not in ("EventWeighted", "TimeWeighted"):
        raise ValueError(f"unknown basis {basis}")
    unknown = [x for x in types if x not in SUMMARY_TYPES]
    if unknown:
        raise ValueError(f"unknown summary types {unknown}")
    kind = df.schema[ts].dataType.simpleString()
    width = _width(duration or (end - start))
    flag = F.col(good) if good else F.lit(True)
    named = df.select(tag, F.col(ts).alias("__t"), F.col(value).cast("double").alias("__v"), flag.alias("__g"))
    d = named.filter((F.col("__t") >= F.lit(start)) & (F.col("__t") < F.lit(end)))
    v, g = F.col("__v"), F.col("__g")
    if basis == "EventWeighted":
        d = d.withColumn("__b", _bucket(F.col("__t"), start, width))
        ok = F.when(g, v)
        stats = _statistics(F.lit(1.0), v, g, F.sum(ok), F.count(ok).cast("double"))
        stats["StdDev"] = F.stddev_samp(ok)
        stats["PopulationStdDev"] = F.stddev_pop(ok)
    else:
        held = named.filter(F.col("__t") < F.lit(start)).groupBy(tag).agg(F.max_by(F.struct("__v", "__g"), "__t").alias("__h"))
        held = held.select(tag, F.lit(start).cast(kind).alias("__t"), "__h.__v", "__h.__g", F.lit(0).alias("__own"))
        d = d.withColumn("__own", F.lit(1)).unionByName(held)
        d = ordered.lead_value(d, [tag], ["__t", "__own"], "__t", "__next")
        lo, hi = _us(F.col("__t")) - _lit_us(start), F.coalesce(_us(F.col("__next")), _lit_us(end)) - _lit_us(start)
        d = d.select(tag, "__v", "__g", lo.alias("__lo"), hi.alias("__hi")).filter("__hi > __lo")
        first, last = F.floor(F.col("__lo") / width).cast("bigint"), F.floor((F.col("__hi") - 1) / width).cast("bigint")
        d = explode_range(d, first, last, "__b")
        piece = F.least(F.col("__hi"), (F.col("__b") + 1) * width) - F.greatest(F.col("__lo"), F.col("__b") * width)
        d = d.withColumn("__w", piece / 1e6)
        w = F.col("__w")
        ok = g & v.isNotNull()
        stats = _statistics(w, v, g, F.sum(F.when(ok, w * v)) / 86400, F.coalesce(F.sum(F.when(ok, w)), F.lit(0.0)))
        stats["StdDev"] = stats["PopulationStdDev"]
    per = d.groupBy(tag, "__b").agg(*[stats[x].cast("double").alias(x) for x in types])
    wide = per.select(tag, bucket_start(F.col("__b"), start, width, kind).alias(ts), *types)
    return wide.unpivot([tag, ts], types, "type", value)


FUNCTIONS = {
    "Average": F.avg, "Total": F.sum, "Minimum": F.min, "Maximum": F.max, "Count": F.count,
    "StdDev": F.stddev_samp, "PopulationStdDev": F.stddev_pop,
}


def calculated(df: DataFrame, start: dt.datetime, end: dt.datetime, interval: dt.timedelta, fn: str = "Average", tag: str = "tag", ts: str = "ts", value: str = "value") -> DataFrame:
    """(tag, ts, value, calculation_type): one aggregate per interval and tag."""
    if fn not in FUNCTIONS:
        raise ValueError(f"unknown calculation {fn}")
    kind = df.schema[ts].dataType.simpleString()
    width = _width(interval)
    d = df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    per = d.groupBy(tag, _bucket(F.col(ts), start, width).alias("__b")).agg(FUNCTIONS[fn](value).cast("double").alias(value))
    return per.select(tag, bucket_start(F.col("__b"), start, width, kind).alias(ts), value, F.lit(fn).alias("calculation_type"))


# --- event frames -----------------------------------------------------------------------


def event_frames(df: DataFrame, start, end, mode: str = "Overlapped", order: list[str] = (), start_index: int = 0, max_count: int | None = None, s: str = "start_time", e: str = "end_time") -> DataFrame:
    """Frames by their relation to ``[start, end]``; an open end is still active.

    Modes: Overlapped, Inclusive (inside), StartInclusive, EndInclusive, ForwardFromStart.
    """
    lo, hi, a, b = F.lit(start), F.lit(end), F.col(s), F.col(e)
    ends_in = F.coalesce((b >= lo) & (b <= hi), F.lit(False))
    tests = {
        "Overlapped": (a <= hi) & (b.isNull() | (b >= lo)),
        "Inclusive": (a >= lo) & ends_in,
        "StartInclusive": (a >= lo) & (a <= hi),
        "EndInclusive": ends_in,
        "ForwardFromStart": a >= lo,
    }
    if mode not in tests:
        raise ValueError(f"unknown search mode {mode}")
    out = df.filter(tests[mode])
    if max_count is not None or start_index:
        out = ordered.rows_between(out, list(order or [s]), start_index, None if max_count is None else start_index + max_count)
    return out


def frame_statistics(frames: DataFrame, samples: DataFrame, end: dt.datetime, tag: str = "tag", ts: str = "ts", s: str = "start_time", e: str = "end_time") -> DataFrame:
    """Frames with ``samples`` (how many lie in ``start <= ts < end``) and ``last_sample``, without pairing them.

    The number of a tag's samples before a time is a running count; a frame's count is the difference of those at its
    ends, looked up once for every distinct time. Linear in frames and samples.
    """
    f = frames.withColumn("__stop", F.coalesce(F.col(e), F.lit(end)))
    x = samples.select(tag, F.col(ts).alias("__t"), F.lit(1).cast("bigint").alias("__n"), F.col(ts).alias("__s"))
    x = x.groupBy(tag, "__t").agg(F.sum("__n").alias("__n"), F.max("__s").alias("__s"))
    points = f.select(tag, F.explode(F.array(s, "__stop")).alias("__t")).distinct()
    both = x.withColumn("__kind", F.lit(1)).unionByName(points.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    both = ordered.with_chunk(both, [tag], ["__t", "__kind"])  # both steps share its partitioning
    both = ordered.running_total(both, [tag], ["__t", "__kind"], F.coalesce("__n", F.lit(0)), "__before")
    both = ordered.fill_value(both, [tag], ["__t", "__kind"], "__s", "__last")
    at = both.filter("__kind = 0")
    first, last = at.select(tag, F.col("__t").alias(s), F.col("__before").alias("__b0")), at.select(
        tag, F.col("__t").alias("__stop"), F.col("__before").alias("__b1"), "__last"
    )
    out = f.join(first, [tag, s], "left").join(last, [tag, "__stop"], "left")
    count = F.greatest(F.coalesce(F.col("__b1") - F.col("__b0"), F.lit(0)), F.lit(0))
    return out.withColumn("samples", count).withColumn("last_sample", F.when(count > 0, F.col("__last"))).drop("__stop", "__b0", "__b1", "__last")


def frame_samples(frames: DataFrame, samples: DataFrame, end: dt.datetime, tag: str = "tag", ts: str = "ts", s: str = "start_time", e: str = "end_time") -> DataFrame:
    """Samples within each frame of the same tag (``start <= ts < end``, an open frame until ``end``): all pairs, so
    as large as the frames are long. For counts and last values see ``frame_statistics``. Frames may be of very unequal length.
    The numbered samples and the frames are written once.
    """
    stop = F.coalesce(F.col(e), F.lit(end))
    return points_in_many(samples, frames.filter(F.col(s).isNotNull()), _us(F.col(ts)), _us(F.col(s)), _us(stop), [tag])


def frame_elements(frames: DataFrame, elements: str, key: str, s: str = "start_time") -> DataFrame:
    """Frame x referenced element rows; the frame's start is the cursor."""
    return frames.select(key, F.explode(elements).alias("element"), F.col(s).alias("cursor"))


def point_catalog(df: DataFrame, descriptor: str, unit: str) -> DataFrame:
    """(type, unit, count) ordered by count, then names; type is the descriptor's first word."""
    word = F.regexp_extract(F.coalesce(F.trim(descriptor), F.lit("")), r"^(\S+)", 1)
    kind = F.when(word == "", "Unknown").otherwise(word)
    out = df.groupBy(kind.alias("type"), F.coalesce(F.col(unit), F.lit("")).alias("unit")).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), "type", "unit")


def dedupe_page_overlap(df: DataFrame, tag: str = "tag", ts: str = "ts") -> DataFrame:
    """Pages that resume at the slowest tag repeat rows of the others: (tag, ts) once."""
    return df.dropDuplicates([tag, ts])


def page_resume(page: DataFrame, tag: str = "tag", ts: str = "ts") -> DataFrame:
    """Where the next multi-tag page starts: 1 µs after the earliest of the tags' last times."""
    last = page.groupBy(tag).agg(F.max(ts).alias("t"))
    return last.agg((F.min("t") + F.expr("interval 1 microsecond")).alias("resume"))
