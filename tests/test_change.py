"""Change application: ties, deletes, snapshots, and targets fed in any batching."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import change as ch
from tidemark.streaming.apply import AppendTarget, MergeTarget, SnapshotTarget

SCHEMA = "k bigint, seq bigint, v string, __deleted boolean"


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def feed_rows():
    """400 changes, a third of them for one key, some deletes, no two on one sequence."""
    rnd = random.Random(7)
    out = []
    for seq in range(400):
        key = 0 if rnd.random() < 0.33 else rnd.randrange(1, 25)
        dead = rnd.random() < 0.15
        out.append((key, seq, None if dead else f"v{seq}", dead))
    return out


def brute_scd1(rows):
    last = {}
    for k, seq, v, dead in sorted(rows, key=lambda r: r[1]):
        last[k] = (k, seq, v, dead)
    return sorted((r[:3] for r in last.values() if not r[3]), key=str)


def brute_scd2(rows):
    out, by_key = [], {}
    for r in sorted(set(rows), key=lambda r: r[1]):
        by_key.setdefault(r[0], []).append(r)
    for events in by_key.values():
        for a, b in zip(events, [*events[1:], None]):
            if not a[3]:
                out.append((a[0], a[2], a[1], b[1] if b else None))
    return sorted(out, key=str)


def test_batch_against_brute_force(spark):
    rows = feed_rows()
    df = spark.createDataFrame(rows + rows[::3], SCHEMA)
    assert _rows(ch.apply_scd1(df, ["k"], "seq", "__deleted"), "k", "seq", "v") == brute_scd1(rows)
    assert _rows(ch.apply_scd2(df, ["k"], "seq", "__deleted"), "k", "v", "__START_AT", "__END_AT") == brute_scd2(rows)


@pytest.mark.parametrize("scd_type,seed", [(1, 1), (2, 2)])
def test_target_does_not_depend_on_batching(spark, folder, scd_type, seed):
    rows = feed_rows()
    rnd = random.Random(seed)
    stream = rows + rnd.sample(rows, 60)  # shuffled and partly redelivered
    rnd.shuffle(stream)
    schema = spark.createDataFrame([], SCHEMA).schema
    t = MergeTarget(spark, folder, schema, ["k"], "seq", scd_type)
    cuts = sorted(rnd.sample(range(1, len(stream)), 2))
    parts = [stream[a:b] for a, b in zip([0, *cuts], [*cuts, len(stream)])]
    for i, part in enumerate(parts):
        t.apply(spark.createDataFrame(part, SCHEMA), i)
        t.apply(spark.createDataFrame(part, SCHEMA), i)  # the batch is repeated after a failure
        if i == 1:
            t.compact()
    if scd_type == 1:
        assert _rows(t.read(), "k", "seq", "v") == brute_scd1(rows)
    else:
        assert _rows(t.read(), "k", "v", "__START_AT", "__END_AT") == brute_scd2(rows)
    before = _rows(t.read(), "k", "v")
    assert t.compact() == len(parts) - 1
    t.log.forget()
    assert t.log.since(-1).count() == 0 and _rows(t.read(), "k", "v") == before


def test_late_upsert_does_not_resurrect(spark, folder):
    t = MergeTarget(spark, folder, spark.createDataFrame([], SCHEMA).schema, ["k"], "seq", 1)
    t.apply(spark.createDataFrame([(1, 5, "a", False)], SCHEMA), 0)
    t.apply(spark.createDataFrame([(1, 9, None, True)], SCHEMA), 1)
    t.apply(spark.createDataFrame([(1, 7, "late", False)], SCHEMA), 2)
    assert t.read().collect() == []
    t.apply(spark.createDataFrame([(1, 10, "new", False)], SCHEMA), 3)
    assert _rows(t.read(), "k", "v") == [(1, "new")]


def test_delete_wins_on_equal_sequence(spark):
    rows = [(1, 5, "a", False), (1, 5, None, True), (2, 5, "b", False)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, SCHEMA)
        assert _rows(ch.apply_scd1(df, ["k"], "seq", "__deleted"), "k", "v") == [(2, "b")]


def test_tie_is_decided_the_same_way_in_any_order(spark):
    rows = [(1, 5, x, False) for x in "abcde"]
    got = {_rows(ch.latest(spark.createDataFrame(random.Random(i).sample(rows, 5), SCHEMA), ["k"], "seq"), "v")[0] for i in range(4)}
    assert len(got) == 1


def test_null_sequence_is_quarantined(spark, folder):
    t = MergeTarget(spark, folder, spark.createDataFrame([], SCHEMA).schema, ["k"], "seq", 1)
    t.apply(spark.createDataFrame([(1, None, "x", False), (None, 3, "y", False), (2, 3, "z", False)], SCHEMA), 0)
    assert _rows(t.read(), "k") == [(2,)]
    assert t.quarantine().count() == 2


def test_soft_and_hard_tombstones(spark):
    rows = [(1, 1, "a", False), (1, 2, None, True), (2, 1, "b", False)]
    df = spark.createDataFrame(rows, "k bigint, seq bigint, v string, _deleted boolean")
    assert _rows(ch.apply_inband_tombstones(df, ["k"], "seq"), "k", "_deleted") == [(1, True), (2, False)]
    assert _rows(ch.apply_inband_tombstones(df, ["k"], "seq", mode="hard"), "k") == [(2,)]
    two = ch.apply_inband_tombstones(df, ["k"], "seq", mode="hard", scd_type=2)
    assert _rows(two, "k", "__START_AT", "__END_AT") == [(1, 1, 2), (2, 1, None)]
    with pytest.raises(ValueError):
        ch.apply_inband_tombstones(df, ["k"], "seq", mode="no")


def test_snapshot_target_history(spark, folder):
    snaps = [
        [(1, "a", {"x": 1}), (2, "b", None)],
        [(1, "a", {"x": 1}), (2, "B", None), (3, "c", {"y": 2})],
        [(2, "B", None), (3, "c", {"y": 3})],
    ]
    t = SnapshotTarget(spark, folder, ["k"], 2)
    for v, rows in enumerate(snaps):
        df = spark.createDataFrame(rows, "k bigint, v string, m map<string,int>")
        t.apply(df, v)
        t.apply(df, v)
    assert _rows(t.read(), "k", "v", "__START_AT", "__END_AT") == sorted(
        [(1, "a", 0, 2), (2, "b", 0, 1), (2, "B", 1, None), (3, "c", 1, 2), (3, "c", 2, None)], key=str
    )


def test_snapshot_diff_with_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k bigint, v string")
    b = spark.createDataFrame([(1, None), (2, None), (4, "z")], "k bigint, v string")
    assert _rows(ch.snapshot_diff(a, b, ["k"]), "k", "v", "op") == [(2, None, "U"), (3, "y", "D"), (4, "z", "I")]


def test_append_dedupes_reread_rows(spark, folder):
    df = spark.createDataFrame([(i, i) for i in range(20)], "id bigint, c bigint")
    t = AppendTarget(spark, folder, df.schema, ["id"], "c")
    t.apply(df.filter("c < 10"), 0)
    t.apply(df.filter("c >= 6"), 1)
    t.apply(df.filter("c >= 6"), 1)
    assert _rows(t.read(), "id") == sorted(((i,) for i in range(20)), key=str)


def test_clustered_splits_a_hot_value(spark):
    df = spark.range(4000).select(F.lit("hot").alias("c"), "id")
    sizes = [len(p) for p in ch.clustered(df, ["c"], 4).rdd.glom().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_full_row_dedupe_with_maps(spark):
    rows = [(1, {"a": 1, "b": 2}), (1, {"b": 2, "a": 1}), (1, {"a": 1}), (1, None), (1, None)]
    assert ch.full_row_dedupe(spark.createDataFrame(rows, "k int, m map<string,int>")).count() == 3


def test_diff_by_digest_equals_the_full_join(spark, folder):
    import random

    rng = random.Random(4)
    for n in (0, 3, 400):
        old = {(i, i % 3): rng.choice("abc") for i in range(n)}
        new = {k: (rng.choice("abcd") if rng.random() < 0.02 else v) for k, v in old.items() if rng.random() > 0.01}
        new |= {(1000 + i, 0): None for i in range(2)}
        make = lambda d: spark.createDataFrame([(a, b, v, {"x": v}) for (a, b), v in d.items()], "a int, b int, v string, m map<string,string>")
        p, s = make(old), make(new)
        want = sorted(map(str, ch.snapshot_diff(p, s, ["a", "b"]).collect()))
        assert sorted(map(str, ch.snapshot_diff_by_digest(p, s, ["a", "b"], 64).collect())) == want
        stored = ch.bucket_digests(p, ["a", "b"], 64)
        assert sorted(map(str, ch.snapshot_diff_by_digest(p, s, ["a", "b"], 64, stored).collect())) == want
        assert ch.differing_buckets(stored, stored).count() == 0


def test_one_changed_row_reads_one_bucket(spark, folder):
    p = spark.range(2000).selectExpr("id", "id % 7 as v")
    s = p.withColumn("v", F.when(F.col("id") == 1234, 99).otherwise(F.col("v")))
    ch.with_bucket(p, ["id"], 16).write.partitionBy("__bucket").parquet(folder + "/prev")
    prev = spark.read.parquet(folder + "/prev")
    digests = ch.bucket_digests(prev, ["id"], 16)
    assert ch.differing_buckets(digests, ch.bucket_digests(s, ["id"], 16)).count() == 1
    out = ch.snapshot_diff_by_digest(prev, s, ["id"], 16, digests)
    assert [(r.id, r.v, r.op) for r in out.collect()] == [(1234, 99, "U")]
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
