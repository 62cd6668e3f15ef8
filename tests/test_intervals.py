"""Points in intervals of any length."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import partition as pt
from tidemark.operators import timeseries as ts
from tidemark.operators import intervals, ordered
from tidemark.operators.intervals import points_in, points_in_many


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    top = 1 << 50
    points = [(i, rng.choice("ab"), rng.choice([rng.randint(-50, 50), rng.randint(-top, top), -1, 0, 1])) for i in range(200)] + [(900, "a", None)]
    spans = []
    for i in range(120):
        lo = rng.choice([None, rng.randint(-60, 60), rng.randint(-top, top)])
        hi = rng.choice([None, rng.randint(-60, 60)]) if lo is None else lo + rng.choice([0, -5, 1, 2, 3, 4, 5, 15, 16, 17, 1000, 4**20, 4**20 + 1, top, 3 * top])
        spans.append((i, rng.choice("abc"), lo, hi))
    p = spark.createDataFrame(points, "i int, g string, x bigint").repartition(3)
    s = spark.createDataFrame(spans, "j int, g string, a bigint, b bigint")
    got = [(r.i, r.j) for r in points_in(p, s, F.col("x"), F.col("a"), F.col("b"), ["g"]).collect()]
    want = [(i, j) for i, g, x in points for j, h, a, b in spans if x is not None and g == h and (a is None or x >= a) and (b is None or x < b) and not (a is not None and b is not None and b <= a)]
    assert sorted(got) == sorted(want) and len(want) > 100
    assert points_in(p, s.limit(0), F.col("x"), F.col("a"), F.col("b"), ["g"]).count() == 0
    assert points_in(p.limit(0), s, F.col("x"), F.col("a"), F.col("b"), ["g"]).count() == 0


def test_short_last_window_and_open_first_window(spark):
    since = dt.datetime(2024, 1, 1)
    w = pt.plan_windows(spark, since, since + dt.timedelta(days=2, microseconds=1), 1)
    assert w.count() == 3
    rows = spark.createDataFrame(
        [(i, since + dt.timedelta(days=i, microseconds=m)) for i in range(-1, 4) for m in (0, 1, 2)] + [(99, None)], "k int, c timestamp_ntz"
    ).withColumn("k", F.monotonically_increasing_id())
    got = {r.matches: r["rows"] for r in pt.coverage(rows, "c", "k", w).collect()}
    assert got == {1: 7, 0: 9}
    first = pt.plan_windows(spark, None, since, 1)
    assert pt.match_windows(rows, "c", first).count() == 4  # all up to it


def test_second_and_year_frames_in_one_plan(spark):
    t0 = dt.datetime(2024, 1, 1)
    frames = spark.createDataFrame(
        [(1, "t", t0, t0 + dt.timedelta(microseconds=1)), (2, "t", t0, t0 + dt.timedelta(days=366)), (3, "t", t0 + dt.timedelta(days=9), None), (4, "u", t0, None), (5, "t", None, t0)],
        "frame_id int, tag string, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    samples = spark.createDataFrame([("t", t0 + dt.timedelta(days=d), float(d)) for d in range(0, 400, 5)], "tag string, ts timestamp_ntz, value double")
    got = {r.frame_id: r.n for r in ts.frame_samples(frames, samples, t0 + dt.timedelta(days=20)).groupBy("frame_id").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 1, 2: 74, 3: 2}


@pytest.mark.parametrize("seed", range(2))
def test_many_points_in_intervals(spark, seed, monkeypatch):
    rng = random.Random(seed)
    low, top = -(1 << 63), (1 << 63) - 1
    monkeypatch.setattr(intervals, "RUN", 8)
    monkeypatch.setattr(ordered, "default_parts", lambda df: 7)  # groups are hot
    points = [(i, rng.choice("ab"), rng.choice([rng.randint(-50, 50), 7, 7, low, top])) for i in range(300)] + [(900, "a", None), (901, None, 7)]
    spans = [(j, rng.choice("abc"), rng.choice([None, 7, 8, low, rng.randint(-60, 60)]), rng.choice([None, 7, 8, top, rng.randint(-60, 60)])) for j in range(150)]
    spans += [(500 + j, "a", -20, 40) for j in range(100)] + [(600, None, 0, 9), (601, "a", 0, 40), (601, "a", 0, 40)]
    p = spark.createDataFrame(points, "i int, g string, x bigint").repartition(3)
    s = spark.createDataFrame(spans, "j int, g string, a bigint, b bigint")
    args = (F.col("x"), F.col("a"), F.col("b"), ["g"])
    out = points_in_many(p, s, *args)
    want = [(i, j) for i, g, x in points for j, h, a, b in spans if x is not None and g is not None and g == h and (a is None or x >= a) and (b is None or x < b) and not (a is not None and b is not None and b <= a)]
    assert sorted((r.i, r.j) for r in out.collect()) == sorted(want) and out.columns == points_in(p, s, *args).columns == ["g", "i", "x", "j", "a", "b"]
    assert points_in_many(p, s.limit(0), *args).count() == points_in_many(p.limit(0), s, *args).count() == 0


def test_pairs_of_overlapping_frames_are_spread(spark, monkeypatch):
    """Frames that are open to the end met all their samples in one task."""
    monkeypatch.setattr(intervals, "RUN", 64)
    t0 = dt.datetime(2024, 1, 1)
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz")
    samples = spark.range(4096).select(F.lit("t").alias("tag"), at.alias("ts"), F.lit(1.0).alias("value"))
    frames = spark.range(400).select(F.col("id").alias("frame_id"), F.lit("t").alias("tag"), at.alias("start_time"), F.lit(None).cast("timestamp_ntz").alias("end_time"))
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        per = ts.frame_samples(frames, samples, t0 + dt.timedelta(seconds=4000)).groupBy(F.spark_partition_id()).agg(F.count("frame_id").alias("n")).collect()
    finally:
        for k in settings:
            spark.conf.unset(k)
    total = sum(r.n for r in per)
    assert total == sum(4000 - i for i in range(400)) and max(r.n for r in per) < total / 2


def test_tiles_of_many_points_in_intervals(spark, monkeypatch):
    rng = random.Random(5)
    for name, n in {"RUN": 4, "RUNS": 3, "INTERVALS": 6, "TILES": 1}.items():
        monkeypatch.setattr(intervals, name, n)
    points = [(i if i % 7 else None, rng.choice("ab"), rng.choice([rng.randint(-50, 50), 7])) for i in range(200)]
    spans = [(j if j % 5 else None, rng.choice("abc"), rng.choice([None, 7, rng.randint(-60, 60)]), rng.choice([None, 8, rng.randint(-60, 60)])) for j in range(80)]
    p = spark.createDataFrame(points * 2, "i int, g string, x bigint")
    s = spark.createDataFrame(spans * 2, "j int, g string, a bigint, b bigint")
    args = (F.col("x"), F.col("a"), F.col("b"), ["g"])
    rows = lambda df: sorted(map(repr, df.collect()))
    got = rows(points_in_many(p, s, *args))
    assert got == rows(points_in(p, s, *args)) and len(got) > 4000


def test_partitions_of_pairs_see_few_intervals(spark, monkeypatch):
    """Every partition met all open frames, so what it totals for each grew with their number."""
    monkeypatch.setattr(intervals, "RUN", 64)
    monkeypatch.setattr(intervals, "INTERVALS", 50, raising=False)
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz")
    samples = spark.range(4096).select(F.lit("t").alias("tag"), at.alias("ts"), F.lit(1.0).alias("value"))
    frames = spark.range(400).select(F.col("id").alias("frame_id"), F.lit("t").alias("tag"), at.alias("start_time"), F.lit(None).cast("timestamp_ntz").alias("end_time"))
    pairs = ts.frame_samples(frames, samples, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=4000))
    per = pairs.groupBy(F.spark_partition_id()).agg(F.count("frame_id").alias("n"), F.countDistinct("frame_id").alias("frames")).collect()
    assert sum(r.n for r in per) == sum(4000 - i for i in range(400)) and max(r.frames for r in per) < 200


def test_many_points_in_intervals_of_a_type_that_is_not_written(spark):
    p = spark.createDataFrame([(1, "a", 5), (2, "a", 9)], "i int, g string, x bigint")
    s = spark.createDataFrame([(1, "a", 0), (2, "a", 6)], "j int, g string, a bigint").withColumns({"b": F.lit(None), "c": F.expr("make_interval(1)")})
    out = points_in_many(p, s, F.col("x"), F.col("a"), F.col("b"), ["g"])
    assert sorted((r.i, r.j) for r in out.select("i", "j").collect()) == [(1, 1), (2, 1), (2, 2)]
