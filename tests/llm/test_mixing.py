import hashlib
import math

import duckdb
import pytest

from tidemark.llm import mixing


def count(u, rate):
    k, p, total = 0, math.exp(-rate), math.exp(-rate)
    while u >= total and k < 10_000:
        k += 1
        p *= rate / k
        total += p
    return k


def u_of(doc, seed=17):
    text = f"{seed}|{'null' if doc is None else doc}"
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52


def test_counts_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    weights = spark.createDataFrame([(f"src{i}", float(i % 4)) for i in range(20)], "source string, weight double")
    rows = mixing.mix(docs, weights, epochs=3.0).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text)
    w = {f"src{i}": float(i % 4) for i in range(20)}
    total, share = sum(sizes.values()), sum(v for k, v in w.items() if sizes.get(k))
    want = {}
    for r in docs.collect():
        n = count(u_of(r.doc_id), 3.0 * (w.get(r.source, 0) / share) / (sizes[r.source] / total))
        if n:
            want[r.doc_id] = n
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r.copy)
    assert {k: len(v) for k, v in got.items()} == want
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in got.values())
    order = [r.shuffle_key for r in mixing.mix(docs, weights, epochs=3.0).coalesce(1).sortWithinPartitions("shuffle_key").collect()]
    assert order == sorted(order) and len(set(order)) == len(order)


def test_sql_gives_the_same_rows(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(map(str, con.execute(f"select doc_id, copy, shuffle_key, text from ({mixing.ORACLE})").fetchall()))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(str((r.doc_id, r.copy, r.shuffle_key, r.text)) for r in mixing.mix(docs).collect())
    assert got == want


def test_rate_is_the_mean(spark):
    from pyspark.sql import functions as F

    for rate in (0.2, 1.0, 30.0, 600.0):
        df = spark.range(4000).select(mixing.poisson(mixing.uniform(3, F.col("id")), F.lit(rate)).alias("n"))
        mean = df.agg(F.avg("n")).first()[0]
        assert abs(mean - rate) < 5 * math.sqrt(rate / 4000)


def test_odd_rows(odd, none):
    rows = mixing.mix(odd, epochs=20.0)
    assert set(rows.columns) == set(odd.columns) | {"shuffle_key"}
    found = {r.doc_id for r in rows.collect()}
    assert found >= {1, 2, 6, 7, 8}  # a null source is a source
    assert mixing.mix(none).collect() == []


def test_rates_too_large_raise(odd):
    with pytest.raises(Exception, match="above 700"):
        mixing.mix(odd, epochs=5000.0).collect()


def test_rates_above_700_are_sums_of_counts(spark):
    docs = spark.createDataFrame([(0, "a" * 10, "small")] + [(i, "b" * 100, "large") for i in range(1, 401)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("small", 0.5), ("large", 0.5)], "source string, weight double")
    rate = 0.5 / (10 / 40010)  # 2000.5
    copies = [r.doc_id for r in mixing.mix(docs, weights).select("doc_id").collect()].count(0)
    parts = math.ceil(rate / 700)
    want = sum(count(int(hashlib.md5(f"17|0|{k}".encode()).hexdigest()[:13], 16) / 2**52, rate / parts) for k in range(1, parts + 1))
    assert copies == want and abs(copies - rate) < 6 * math.sqrt(rate)


def test_rows_without_ids_and_with_one_id(spark):
    """Null ids draw by their texts; neither they nor rows of one id meet in one task."""
    from pyspark.sql import functions as F

    hot = next(d for d in range(100) if count(u_of(d), 2.0))
    rows = [(None, f"text {i}", "a") for i in range(400)] + [(hot, f"other {i}", "a") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = mixing.mix(docs, epochs=2.0).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {t: count(u_of("null " + hashlib.md5(t.encode()).hexdigest()), 2.0) for d, t, _ in rows if d is None}
    got = {}
    for r in out:
        if r.doc_id is None:
            got[r.text] = got.get(r.text, 0) + 1
    assert got == {t: n for t, n in want.items() if n}
    assert len({r.shuffle_key for r in out if r.doc_id is None}) == sum(want.values())
    assert sum(r.doc_id == hot for r in out) == 400 * count(u_of(hot), 2.0)
    assert len({r.part for r in out if r.doc_id == hot}) > 2  # one task per key would be as many as copies
