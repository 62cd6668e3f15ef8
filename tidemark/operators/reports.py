"""Product-analytics reports over event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import FLOAT_METRICS, INTEGER_METRICS
from tidemark.operators import ordered


def report(
    df: DataFrame,
    dimensions: list[str],
    metrics: dict[str, Column],
    dimension_filter: str | None = None,
    metric_filter: str | None = None,
    order: list[str] = (),
) -> DataFrame:
    """Metrics by dimensions; dimension filters apply before, metric filters after grouping."""
    if dimension_filter:
        df = df.filter(dimension_filter)
    out = df.groupBy(*dimensions).agg(*[m.alias(n) for n, m in metrics.items()])
    if metric_filter:
        out = out.filter(metric_filter)
    return out.orderBy(*order) if order else out


def property_reports(properties: dict[str, DataFrame], build, key: str = "property_id") -> DataFrame:
    """The same report for several properties, each row with its property."""
    from tidemark.operators.family import union_groups

    return union_groups({name: build(df) for name, df in properties.items()}, key)


def metric_type(name: str) -> T.DataType:
    """Spark type of a declared report metric type; unknown ones stay text."""
    if name in INTEGER_METRICS:
        return T.LongType()
    return T.DoubleType() if name in FLOAT_METRICS else T.StringType()


def active_users(df: DataFrame, user: str, ts: str, by: str | None = None, unit: str = "day", approximate: bool = False) -> DataFrame:
    """(date, segment, count): distinct users per interval and segment; ``Totals`` without one."""
    segment = F.col(by) if by else F.lit("Totals")
    count = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    return df.groupBy(F.to_date(F.date_trunc(unit, ts)).alias("date"), segment.alias("segment")).agg(count.alias("count"))


def dense_ids(df: DataFrame, user: str, out: str = "user_no") -> DataFrame:
    """(user, number): users numbered without gaps, so that their bitmaps are full rather than many."""
    return ordered.row_index(df.select(user).filter(F.col(user).isNotNull()).distinct(), [], [user], out)


def daily_bitmaps(df: DataFrame, number: str, ts: str, by: str | None = None) -> DataFrame:
    """(date, segment, bucket, users): a day's users as bitmaps of 32 768 numbers each, to be stored and merged later.

    Users may be counted as often as they occur; a bitmap of one size is all that a task keeps or sends for a bucket.
    """
    segment = F.col(by) if by else F.lit("Totals")
    bucket = F.bitmap_bucket_number(F.col(number).cast("bigint"))
    rows = df.filter(F.col(number).isNotNull()).groupBy(F.to_date(ts).alias("date"), segment.alias("segment"), bucket.alias("bucket"))
    return rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number).cast("bigint"))).alias("users"))


def active_users_of(bitmaps: DataFrame, unit: str = "day") -> DataFrame:
    """(date, segment, count) for any interval of whole days: bitmaps are united, so a user of several days counts once."""
    start = F.to_date(F.date_trunc(unit, "date")).alias("date")
    merged = bitmaps.groupBy(start, "segment", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy("date", "segment").agg(F.sum(F.bitmap_count("users")).alias("count"))


def sessions(df: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    """(user, start, end, seconds, events): a pause of ``gap_seconds`` or more ends a session.

    Gaps and islands instead of a session window: the events of one user are split along
    time, so a user with a large part of the table does not end up in one task. Events of a
    user at the same instant are counted together before the first shuffle.
    """
    e = df.groupBy(user, ts).agg(F.count(F.lit(1)).alias("__n"))
    e = ordered.with_chunk(e, [user], [ts])  # both steps share its partitioning
    e = ordered.lag_value(e, [user], [ts], ts, "__prev")
    pause = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("__prev").cast("timestamp"))
    first = F.col("__prev").isNull() | (pause >= gap_seconds * 1_000_000)
    e = ordered.running_total(e, [user], [ts], first.cast("bigint"), "__sid")
    s = e.groupBy(user, "__sid").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.sum("__n").alias("events"))
    micros = F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))
    return s.select(user, "start", "end", (micros / 1e6).alias("seconds"), "events")


def avg_session_length(df: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    """(date, length): mean seconds of the sessions that start on the day."""
    s = sessions(df, user, ts, gap_seconds)
    return s.groupBy(F.to_date("start").alias("date")).agg(F.avg("seconds").alias("length"))


def session_length_distribution(df: DataFrame, user: str, ts: str, gap_seconds: int, bounds: list[int]) -> DataFrame:
    """(bucket, count): sessions per length bucket; ``bounds`` are the lower bounds in seconds."""
    s = sessions(df, user, ts, gap_seconds)
    label = F.lit(f"<{bounds[0]}")
    for lo, hi in zip(bounds, [*bounds[1:], None]):
        label = F.when(F.col("seconds") >= lo, F.lit(f"{lo}-{hi}" if hi else f">={lo}")).otherwise(label)
    return s.groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


def sessions_per_user(df: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    """(date, avg_sessions): sessions per user that started one on the day."""
    s = sessions(df, user, ts, gap_seconds)
    per = s.groupBy(F.to_date("start").alias("date"), user).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("date").agg((F.sum("n") / F.count(F.lit(1))).alias("avg_sessions"))


def streaming_sessions(stream: DataFrame, user: str, ts: str, gap: str, watermark: str) -> DataFrame:
    """The streaming form of ``sessions``: a session window closed by the watermark."""
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(user, F.session_window(ts, gap).alias("w"))
        .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("events"))
        .drop("w")
    )


def events_list(df: DataFrame, event: str) -> DataFrame:
    return df.groupBy(F.col(event).alias("event_type")).agg(F.count(F.lit(1)).alias("totals"))


def cohort(df: DataFrame, user: str, predicate: str) -> DataFrame:
    """Users with at least one row that satisfies the predicate."""
    return df.filter(predicate).select(user).distinct()


def cohort_sizes(df: DataFrame, user: str, predicates: dict[str, str]) -> DataFrame:
    """(cohort, count): users of each cohort, all in one pass over the table."""
    flags = [F.max(F.expr(p).cast("int")).alias(n) for n, p in predicates.items()]
    per_user = df.groupBy(user).agg(*flags)
    sums = per_user.agg(*[F.sum(F.coalesce(F.col(n), F.lit(0))).cast("bigint").alias(n) for n in predicates])
    return sums.unpivot([], list(predicates), "cohort", "count")


def survey_rollups(df: DataFrame, answers: str) -> DataFrame:
    """(question, choice, count) from a map question -> choice; unanswered ones are not counted."""
    x = df.select(F.explode(answers).alias("question", "choice")).filter(F.col("choice").isNotNull())
    return x.groupBy("question", "choice").agg(F.count(F.lit(1)).alias("count"))


def app_reports(df: DataFrame, kind: str, kinds: dict[str, str], organic: Column, ts: str) -> DataFrame:
    """(report, date, events): event reports by type, each with an ``organic_`` twin."""
    name = F.lit(None).cast("string")
    for value, label in kinds.items():
        name = F.when(F.col(kind) == value, F.lit(label)).otherwise(name)
    full = F.when(organic, F.concat(F.lit("organic_"), name)).otherwise(name)
    rows = df.filter(F.col(kind).isin(list(kinds)))
    return rows.groupBy(full.alias("report"), F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("events"))


def active_profiles(df: DataFrame, user: str, last_seen: list[str]) -> DataFrame:
    """Latest profile per user."""
    from tidemark.operators.change import latest

    return latest(df, [user], last_seen)
