"""Partition planning: disjoint windows, balanced bins, fixed-size chunks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ordered
from tidemark.operators.intervals import points_in


def plan_windows(
    spark: SparkSession, since: dt.datetime | None, until: dt.datetime, days: float, lookback: dt.timedelta = dt.timedelta(0)
) -> DataFrame:
    """Contiguous ``(since, until]`` windows as rows (window, since, until).

    Without ``since`` (first run) one open-ended window; none when nothing is left to read.
    """
    schema = "window bigint, since timestamp_ntz, until timestamp_ntz"
    if since is None:
        return spark.createDataFrame([(0, None, until)], schema)
    start = since - lookback
    if start >= until or since >= until:
        return spark.createDataFrame([], schema)
    secs = days * 86400
    count = int(-(-(until - start).total_seconds() // secs))
    base = F.lit(start)
    lo = base + F.make_interval(secs=F.col("id") * F.lit(secs))
    hi = base + F.make_interval(secs=(F.col("id") + 1) * F.lit(secs))
    return spark.range(count).select(
        F.col("id").alias("window"), lo.cast("timestamp_ntz").alias("since"),
        F.least(hi.cast("timestamp_ntz"), F.lit(until)).alias("until"),
    )


def window_day_ceiling(cursor: dt.datetime | None, window_days: int, init: dt.datetime) -> dt.datetime:
    """``min(cursor + window_days, init)``; a starting date is required."""
    if cursor is None:
        raise ValueError("a starting date is required")
    return min(cursor + dt.timedelta(days=window_days), init)


def match_windows(df: DataFrame, c: str, windows: DataFrame) -> DataFrame:
    """Every (row, window) with ``since < c <= until``, for windows of any lengths, in any order, with gaps and overlaps.

    A null bound is no bound; a window that ends where it starts, or before, holds nothing.
    """
    micros = lambda x: F.unix_micros(F.col(x).cast("timestamp"))
    return points_in(df, windows, micros(c) - 1, micros("since"), micros("until"))


def coverage(df: DataFrame, c: str, key: str, windows: DataFrame) -> DataFrame:
    """(matches, rows): in how many windows each row falls; a sound plan has only ``1``."""
    hits = match_windows(df.select(key, c), c, windows).groupBy(key).agg(F.count(F.lit(1)).alias("m"))
    joined = df.select(key).join(hits, key, "left").select(F.coalesce("m", F.lit(0)).alias("matches"))
    return joined.groupBy("matches").agg(F.count(F.lit(1)).alias("rows"))


def bin_contiguous(df: DataFrame, n: int, order: list[str], out: str = "bin") -> DataFrame:
    """Balanced contiguous slices under a total order; the first ``rows % n`` hold one more."""
    d = ordered.row_index(df, [], order, "__i")
    rows = df.agg(F.count(F.lit(1))).scalar()
    bins = F.least(F.lit(n).cast("bigint"), rows)
    d = d.select("*", rows.alias("__n"), bins.alias("__b"))
    small = F.floor(F.col("__n") / F.col("__b")).cast("bigint")
    extra = F.col("__n") % F.col("__b")
    border = extra * (small + 1)
    slot = F.when(F.col("__i") < border, F.floor(F.col("__i") / (small + 1))).otherwise(
        extra + F.floor((F.col("__i") - border) / small)
    )
    return d.withColumn(out, slot.cast("bigint")).drop("__i", "__n", "__b")


def bin_weighted(df: DataFrame, n: int, weight: str, order: list[str], out: str = "bin") -> DataFrame:
    """Contiguous bins of about equal weight; a null weight counts 1.

    A row belongs to the bin in which the weight before it ends.
    """
    w = F.coalesce(F.col(weight), F.lit(1)).cast("bigint")
    d = ordered.running_total(df, [], order, w, "__cum")
    total = df.agg(F.sum(w)).scalar()
    d = d.select("*", total.alias("__total"))
    slot = F.floor((F.col("__cum") - w) * n / F.col("__total")).cast("bigint")
    return d.withColumn(out, F.least(slot, F.lit(n - 1).cast("bigint"))).drop("__cum", "__total")


def bin_units(df: DataFrame, n: int, unit: list[str], out: str = "bin") -> DataFrame:
    """Distinct units (parent, child) dealt round-robin to ``n`` bins in key order."""
    units = df.select(*unit).distinct()
    return ordered.row_index(units, [], unit, "__i").withColumn(out, F.col("__i") % n).drop("__i")


def chunk_ids(df: DataFrame, key: str, position: str, size: int) -> DataFrame:
    """Ids without repeats, in order of first appearance, in batches of ``size``.

    Each output row holds at most ``size`` ids.
    """
    firsts = df.groupBy(key).agg(F.min(position).alias("__p"))
    placed = ordered.row_index(firsts, [], ["__p", key], "__i")
    chunk = F.floor(F.col("__i") / size).cast("bigint")
    return (
        placed.groupBy(chunk.alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("__i", key))).alias("__l"))
        .select("chunk", F.transform("__l", lambda x: x[key]).alias("ids"))
    )
