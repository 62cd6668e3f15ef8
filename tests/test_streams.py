"""Streaming reads: equal to batch, restart in the middle, bounded replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import family as fm
from tidemark.operators import timeseries as ts
from tidemark.plans.meta import TableMeta
from tidemark.session import scratch_dir
from tidemark.sources import files
from tidemark.streaming.apply import AppendTarget, MergeTarget, SnapshotTarget
from tidemark.streaming.read import append_stream, apply_stream, dedup_stream, finish, join_streams, rocksdb_state


def _land(spark, path, lo, hi):
    spark.range(lo, hi).selectExpr("id", "id * 10 as c").coalesce(1).write.mode("append").parquet(path)


def test_file_stream_continues_after_restart(spark, folder):
    _land(spark, f"{folder}/in", 0, 10)
    src = files.Landed(f"{folder}/in")
    for hi in (10, 25):
        finish(append_stream(files.read_stream(spark, src, 1), f"{folder}/out", f"{folder}/ck"))
        assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == list(range(hi))
        if hi == 10:
            _land(spark, f"{folder}/in", 10, 25)


def test_cursor_stream_keeps_late_ties_and_null_cursors(spark, folder):
    schema = "id bigint, c decimal(20,3)"
    land = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    src = files.Landed(f"{folder}/in", TableMeta(["id"], "c", "cdc"))
    from decimal import Decimal as D

    land([(1, D("1.5")), (2, None), (3, D("2.5"))])
    for more in (None, [(4, D("2.5")), (5, None), (6, D("0.5"))]):
        if more:
            land(more)
        finish(append_stream(files.read_cursor_stream(spark, src, D("1.0")), f"{folder}/out", f"{folder}/ck"))
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2, 3, 4, 5]


def test_partitioned_read_prunes(spark, folder):
    spark.range(100).selectExpr("id", "id * 10 as c", "uuid() as wide").write.parquet(f"{folder}/in")
    src = files.Landed(f"{folder}/in", TableMeta(["id"], "c", "cdc"))
    df = files.read_partitioned(spark, src, 300, 700).select("id")
    assert sorted(r["id"] for r in df.collect()) == list(range(31, 71))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c,300)" in plan and "LessThanOrEqual(c,700)" in plan and "wide" not in plan


def test_failed_batch_is_repeated_once(spark, folder):
    _land(spark, f"{folder}/in", 0, 10)
    schema = spark.read.parquet(f"{folder}/in").schema
    target = MergeTarget(spark, f"{folder}/t", schema, ["id"], "c")
    real, calls = target.apply, []

    def flaky(batch, batch_id, flow):
        calls.append(batch_id)
        real(batch, batch_id, flow)
        if len(calls) == 1:
            raise RuntimeError("lost after the commit")

    target.apply = flaky
    with pytest.raises(Exception, match="lost after the commit"):
        finish(apply_stream(files.read_stream(spark, files.Landed(f"{folder}/in")), target, f"{folder}/ck"))
    finish(apply_stream(files.read_stream(spark, files.Landed(f"{folder}/in")), target, f"{folder}/ck"))
    assert calls == [0, 0] and target.read().count() == 10 and target.log.since(-1).count() == 10


def test_delete_stream_holds_keys_only(spark, folder):
    _land(spark, f"{folder}/in", 0, 3)
    src = files.Landed(f"{folder}/in", TableMeta(["id"], "c", "cdc_with_deletes"), deletes=f"{folder}/in")
    assert files.read_delete_stream(spark, src).columns == ["id", "c", "_deleted"]
    with pytest.raises(ValueError):
        files.read_delete_stream(spark, files.Landed(f"{folder}/in", src.meta))


def test_small_batch_writes_few_rows_and_compaction_keeps_the_state(spark, folder):
    schema = "id bigint, c bigint, v string"
    make = lambda rows: spark.createDataFrame(rows, schema)
    for kind in (1, 2):
        target = MergeTarget(spark, f"{folder}/m{kind}", make([]).schema, ["id"], "c", kind)
        target.apply(make([(i, 1, "a") for i in range(500)]), 0)
        target.apply(make([(1, 5, "b"), (2, 0, "late"), (None, 9, "no key"), (3, None, "no seq")]), 1)
        assert target.log.since(0).count() == 4  # a batch writes its own rows only
        before = sorted(map(str, target.read().collect()))
        assert target.compact() == 1 and sorted(map(str, target.read().collect())) == before
        target.apply(make([(1, 5, "b"), (2, 0, "late"), (None, 9, "no key"), (3, None, "no seq")]), 2)
        assert sorted(map(str, target.read().collect())) == before
        assert target.quarantine().count() == 4
        target.compact()
        target.log.forget()
        assert target.log.since(-1).count() == 0 and sorted(map(str, target.read().collect())) == before


def test_redelivered_rows_without_cursor_or_key_are_seen_once(spark, folder):
    rows = spark.createDataFrame([(1, None), (None, 5), (2, 7), (None, None)], "id bigint, c bigint")
    target = AppendTarget(spark, f"{folder}/a", rows.schema, ["id"], "c")
    for n in (0, 1, 1):
        target.apply(rows, n)
    want = sorted([(1, None), (None, None), (2, 7)], key=str)
    assert sorted(map(tuple, target.read().collect()), key=str) == want
    target.compact()
    target.apply(rows, 2)
    assert sorted(map(tuple, target.read().collect()), key=str) == want


def test_snapshots_number_themselves(spark, folder):
    make = lambda rows: spark.createDataFrame(rows, "id bigint, v string")
    target = SnapshotTarget(spark, f"{folder}/s", ["id"], 2)
    assert [target.apply(make(r)) for r in ([(1, "a"), (2, "b")], [(1, "x"), (2, "b")], [(2, "b"), (3, "c")])] == [0, 1, 2]
    got = sorted(((r.id, r.v, r["__START_AT"], r["__END_AT"]) for r in target.read().collect()), key=str)
    assert got == sorted([(1, "a", 0, 1), (1, "x", 1, 2), (2, "b", 0, None), (3, "c", 2, None)], key=str)
    assert target.apply(make([(2, "b"), (3, "c")]), 2) == 2  # the same again changes nothing
    with pytest.raises(ValueError, match="other rows"):
        target.apply(make([(9, "z")]), 2)


def test_scratch_needs_a_shared_folder(spark):
    assert "tidemark-x-" in scratch_dir(spark, "x")


def test_long_grid_is_made_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",)], "tag string")
    s, step = dt.datetime(2024, 1, 1), dt.timedelta(minutes=1)
    whole = ts.grid(df, s, s + 24 * step, step).collect()
    monkeypatch.setattr(ts, "GRID_BLOCK", 10)
    blocks = ts.grid(df, s, s + 24 * step, step).collect()
    assert sorted(whole) == sorted(blocks) and len(whole) == 50


def test_interpolation_edges(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    s = spark.createDataFrame([("a", at(10), 1.0), ("a", at(20), 3.0)], "tag string, ts timestamp_ntz, value double")
    p = spark.createDataFrame([("a", at(m)) for m in (5, 10, 15, 20, 30)] + [("b", at(5))], "tag string, ts timestamp_ntz")
    got = {(r["tag"], r["ts"].minute): r["value"] for r in ts.value_at(s, p).collect()}
    assert got == {("a", 5): None, ("a", 10): 1.0, ("a", 15): 2.0, ("a", 20): 3.0, ("a", 30): 3.0, ("b", 5): None}
    start, end = ts.time_range(None, None, None, at(59), 30, 600)
    assert (start, end) == (at(29), at(39))


def test_sample_parents(spark):
    df = spark.range(10)
    assert [r["id"] for r in fm.sample_parents(df, "id", None, 3).collect()] == [0, 1, 2]
    assert fm.sample_parents(df, "id", [4], 3).count() == 1


@pytest.mark.parametrize("kind", [1, 2])
@pytest.mark.parametrize("sizes", [(2, 0, 2), (2, 0, 0), (0, 2), (0, 0, 3, 0)])
def test_snapshots_may_be_empty(spark, folder, kind, sizes):
    make = lambda n: spark.createDataFrame([(i, "v") for i in range(n)], "id bigint, v string")
    target = SnapshotTarget(spark, f"{folder}/s", ["id"], kind)
    closed, live = set(), {}
    for at, n in enumerate(sizes):
        assert target.apply(make(n)) == at and target.version() == at
        closed |= {(i, start, at) for i, start in live.items() if i >= n}
        live = {i: live.get(i, at) for i in range(n)}
        rows = target.read().collect()
        if kind == 1:
            assert sorted(r.id for r in rows) == list(range(n))
        else:
            got = {(r.id, r["__START_AT"], r["__END_AT"]) for r in rows}
            assert got == closed | {(i, start, None) for i, start in live.items()} and len(rows) == len(got)
    assert target.apply(make(sizes[-1]), len(sizes) - 1) == len(sizes) - 1
    with pytest.raises(ValueError, match="other rows"):
        target.apply(make(sizes[-1] + 1), len(sizes) - 1)


@pytest.mark.parametrize("kind", [1, 2])
def test_half_written_snapshot_is_not_seen(spark, folder, kind, monkeypatch):
    make = lambda rows: spark.createDataFrame(rows, "id bigint, v string")
    target = SnapshotTarget(spark, f"{folder}/s", ["id"], kind)
    target.apply(make([(1, "a"), (2, "b")]))
    before = sorted(map(str, target.read().collect()))

    def lost(*_):
        raise RuntimeError("lost before the row about it")

    with monkeypatch.context() as m:
        m.setattr(target.published, "add", lost)
        with pytest.raises(RuntimeError, match="lost"):
            target.apply(make([(9, "z")]))
    assert target.version() == 0 and sorted(map(str, target.read().collect())) == before
    assert target.apply(make([(2, "c")])) == 1  # takes the number again, nothing of the lost one stays
    rows = target.read().collect()
    assert {r.id for r in rows} == ({2} if kind == 1 else {1, 2}) and len(rows) == (1 if kind == 1 else 3)


def test_repeated_batch_without_rows_replaces_its_partition(spark, folder):
    make = lambda rows: spark.createDataFrame(rows, "id bigint, c bigint")
    target = MergeTarget(spark, f"{folder}/t", make([]).schema, ["id"], "c")
    target.apply(make([(1, 1)]), 0)
    target.apply(make([]), 0)
    target.apply(make([]), 1)
    assert target.read().count() == 0 and target.log.last() == 1 and target.compact() == 1


def _files_read(df):
    """The scan's own count."""
    execution = df._jdf.queryExecution()
    df._jdf.collect()
    return execution.executedPlan().collectLeaves().head().metrics().get("numFiles").get().value()


def test_changes_read_their_own_buckets_only(spark, folder):
    import random

    schema = "id bigint, c bigint, v string"
    make = lambda rows: spark.createDataFrame(rows, schema)
    rng = random.Random(3)
    for kind in (1, 2):
        target = MergeTarget(spark, f"{folder}/t{kind}", make([]).schema, ["id"], "c", kind, buckets=24)
        whole = MergeTarget(spark, f"{folder}/w{kind}", make([]).schema, ["id"], "c", kind)
        n = 0
        for step in range(3):
            ids = range(400) if step == 0 else rng.sample(range(500), 2)
            rows = [(i, rng.randint(0, 9), rng.choice("abc")) for i in ids] + [(None, 1, "no key"), (ids[0], None, "no seq")]
            gone = rng.random() < 0.5
            for t in (target, whole):
                t.apply(make(rows).withColumn("__deleted", F.lit(gone)), n)
            n += 1
            if step:
                changed = target.touched()
                read, files = (_files_read(df) for df in (target.old_rows(changed), target.log.base(target.schema)))
                assert 0 < len(changed) <= 9 and 0 < read < files / 2  # of two batches at most
                plan = target.read()
                plan.collect()
                assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, target.read().collect())) == sorted(map(str, whole.read().collect()))
            if step != 1:
                assert target.compact() == n - 1
        assert sorted(map(str, target.quarantine().collect())) == sorted(map(str, whole.quarantine().collect()))
        target.log.forget()
        assert sorted(map(str, target.read().collect())) == sorted(map(str, whole.read().collect()))
        target.apply(make([(1, 99, "z")]), n)
        whole.apply(make([(1, 99, "z")]), n)
        assert target.compact(buckets=5) == n and len(target._layout()) == 5
        assert sorted(map(str, target.read().collect())) == sorted(map(str, whole.read().collect()))


def test_redelivery_after_restart_is_dropped_and_state_is_bounded(spark, folder):
    rocksdb_state(spark)
    schema = "id bigint, ts timestamp"
    t0 = dt.datetime(2024, 1, 1)
    held = []
    for day in range(6):  # each run also delivers the day before again
        rows = [(100 * d + i, t0 + dt.timedelta(days=d, minutes=i)) for d in {max(day - 1, 0), day} for i in range(50)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = append_stream(dedup_stream(stream, ["id"], "ts", "2 days"), f"{folder}/out", f"{folder}/ck")
        finish(query)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = [r.id for r in spark.read.parquet(f"{folder}/out").collect()]
    assert len(got) == len(set(got)) == 300
    assert max(held) <= 200 and held[-1] < 300  # keys of the days that the watermark still reaches


def test_joined_streams_equal_the_batch_join(spark, folder):
    t0 = dt.datetime(2024, 1, 1)
    parents = [(i, t0 + dt.timedelta(hours=i), f"p{i}") for i in range(12)]
    children = [(i % 14, t0 + dt.timedelta(hours=i % 14, minutes=i), i) for i in range(60)]
    want = sorted((c, k, n) for c, ts, k in children for p, at, n in parents if c == p)
    ps, cs = "id bigint, at timestamp, name string", "id bigint, ts timestamp, k int"
    for n, cut in enumerate([1, 3]):
        for i in range(cut):  # children first, so their parents are late
            spark.createDataFrame(children[i::cut], cs).coalesce(1).write.mode("append").parquet(f"{folder}/c{n}")
            rows = parents[(cut - 1 - i)::cut]
            spark.createDataFrame(rows, ps).coalesce(1).write.mode("append").parquet(f"{folder}/p{n}")
            p, c = (spark.readStream.schema(x).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{y}{n}") for x, y in ((ps, "p"), (cs, "c")))
            finish(append_stream(join_streams(p, c, "id", "at", "ts", "2 days"), f"{folder}/o{n}", f"{folder}/k{n}"))
        got = sorted((r.id, r.k, r.name) for r in spark.read.parquet(f"{folder}/o{n}").collect())
        assert got == want
