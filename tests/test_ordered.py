"""Chunked ordered operators against plain windows, with a hot group."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordered


def _data(spark, kind: str):
    """300 rows, a third of them in one group, all orders distinct, some values null."""
    rows = []
    for i in range(300):
        group = "hot" if i < 100 else f"g{i % 7}"
        at = (i * 7919) % 3001
        order = {"int": at, "string": f"k{at:05d}", "ts": dt.datetime(2024, 1, 1) + dt.timedelta(minutes=at)}[kind]
        rows.append((group, order, i if i % 3 else None))
    types = {"int": "bigint", "string": "string", "ts": "timestamp_ntz"}
    return spark.createDataFrame(rows, f"g string, o {types[kind]}, v bigint")


@pytest.mark.parametrize("kind,parts", [("int", 1), ("int", 64), ("string", 16), ("ts", 16)])
def test_same_as_plain_window(spark, kind, parts):
    df = _data(spark, kind)
    w = Window.partitionBy("g").orderBy("o")
    upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.select(
        "g", "o", "v", F.lead("v").over(w).alias("next"), F.lag("v").over(w).alias("prev"),
        F.sum(F.coalesce("v", F.lit(0))).over(upto).alias("total"), (F.row_number().over(w) - 1).cast("bigint").alias("i"),
        F.last("v", True).over(upto).alias("before"), F.first("v", True).over(onward).alias("after"),
    )
    got = ordered.lead_value(df, ["g"], ["o"], "v", "next", parts)
    got = ordered.lag_value(got, ["g"], ["o"], "v", "prev", parts)
    got = ordered.running_total(got, ["g"], ["o"], F.coalesce("v", F.lit(0)), "total", parts)
    got = ordered.row_index(got, ["g"], ["o"], "i", parts)
    got = ordered.fill_value(got, ["g"], ["o"], "v", "before", "after", parts)
    key = lambda r: (r["g"], str(r["o"]))
    cols = want.columns
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert len({key(r) for r in got.collect()}) == 300


def _sizes(df, order, parts):
    rows = ordered.with_chunk(df, ["g"], order, parts).groupBy("g", ordered.CHUNK).count().collect()
    return {(r["g"], r[ordered.CHUNK]): r["count"] for r in rows}


def test_hot_group_is_split(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("g"), "id")).otherwise("hot").alias("g"), F.col("id").alias("o"))
    sizes = _sizes(df, ["o"], 32)
    hot = [n for (g, _), n in sizes.items() if g == "hot"]
    assert len(hot) >= 24 and max(hot) < 9_000 / 28 * 2
    assert all(c == 0 for g, c in sizes if g != "hot")  # nobody else is cut


def test_text_keys_with_a_long_common_prefix_are_split(spark):
    df = spark.range(6000).select(F.lit("hot").alias("g"), F.format_string("Customer#0000000000%09d", "id").alias("o"))
    sizes = _sizes(df, ["o"], 16)
    assert len(sizes) == 16 and max(sizes.values()) < 6000 / 16 * 2


def test_frequent_value_is_split_along_the_second_column(spark):
    rows = [("hot", 50 if i % 3 else i % 100, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, o int, id int")
    assert max(_sizes(df, ["o", "id"], 32).values()) < 800  # two thirds of the rows share one order value
    got = ordered.row_index(df, ["g"], ["o", "id"], "i", 32).collect()
    want = {key: i for i, key in enumerate(sorted((o, n) for _, o, n in rows))}
    assert all(r["i"] == want[(r["o"], r["id"])] for r in got) and len(got) == 6000


def test_no_hot_group_means_a_plain_window(spark):
    df = spark.range(5000).select((F.col("id") % 997).alias("g"), F.col("id").alias("o"))
    plan = ordered.lead_value(df, ["g"], ["o"], "o", "n", 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "percentile" not in plan


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, o bigint, v bigint")
    assert ordered.lead_value(df, ["g"], ["o"], "v", "n", 16).collect() == []


def test_parts_follow_the_cluster(spark):
    df = spark.range(1)
    assert ordered.default_parts(df) == 4
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert ordered.default_parts(df) == 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
