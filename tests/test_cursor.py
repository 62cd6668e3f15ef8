"""Edge cases of cursor reads that the SQL checks do not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import cursor_key, entity_key_value, key_family, key_sign
from tidemark.operators import cursor as cur
from tidemark.streaming.drain import drain, progress_guard


def _ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def test_trim_keeps_whole_cohort_or_fails(spark):
    df = spark.createDataFrame([(1, 5), (2, 5)], "id int, c int")
    assert _ids(cur.trim_boundary_cohort(df, "c", truncated=False)) == [1, 2]
    with pytest.raises(Exception, match="raise the batch cap"):
        cur.trim_boundary_cohort(df, "c", truncated=True).collect()
    nulls = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, c int")
    assert _ids(cur.trim_boundary_cohort(nulls, "c", truncated=True)) == [1, 2]


def test_keyset_walk_sees_every_row_once(spark):
    df = spark.createDataFrame([(i, i // 7) for i in range(50)], "id int, c int")
    seen, pos = [], (None, None)
    while True:
        page = cur.keyset_resume(df, "c", "id", *pos, limit=8).collect()
        if not page:
            break
        seen += [r["id"] for r in page]
        pos = (page[-1]["c"], page[-1]["id"])
    assert seen == list(range(50))


def test_keyset_needs_a_tie_break(spark):
    df = spark.createDataFrame([(None, 1)], "id int, c int")
    with pytest.raises(Exception, match="null tie-break"):
        cur.keyset_resume(df, "c", "id").collect()
    with pytest.raises(ValueError):
        cur.keyset_resume(df, "c", "")


def test_cap_keeps_ties_so_nothing_is_lost(spark):
    df = spark.createDataFrame([(i, i // 10) for i in range(40)], "id int, c int")
    seen, since = [], -1
    while True:
        part = cur.limit_keep_ties(cur.cursor_range(df, "c", since), 7, "c").collect()
        if not part:
            break
        seen += [r["id"] for r in part]
        since = max(r["c"] for r in part)
    assert sorted(seen) == list(range(40))


def test_same_cluster_is_read_whole(spark):
    df = spark.createDataFrame([(i, 1) for i in range(9)] + [(9, 2)], "id int, c int")
    assert _ids(cur.same_cluster_redrain(df, "c", 0, 5, 4)) == list(range(10))


def test_cursor_nulls_modes(spark):
    df = spark.createDataFrame([(1, None), (2, dt.date(2024, 1, 1))], "id int, c date")
    floor = cur.cursor_nulls(df, "c", ["id"], "coalesce:1990").orderBy("id").collect()
    assert [r["__cursor"] for r in floor] == [dt.date(1990, 1, 1), dt.date(2024, 1, 1)] and floor[0]["c"] is None
    assert _ids(cur.cursor_nulls(df, "c", ["id"], "ignore")) == [2]
    with pytest.raises(Exception, match="null cursor"):
        cur.cursor_nulls(df, "c", ["id"], "error").collect()
    for bad in ("ignore:2000", "coalesce:90", "maybe"):
        with pytest.raises(ValueError):
            cur.cursor_nulls(df, "c", ["id"], bad)


def test_cursor_key_orders_mixed_renderings(spark):
    texts = [
        "2024-01-01T23:00:00Z", "2024-01-01T23:00:00.5Z", "2024-01-01T23:00:00.1234567Z", "2024-01-01T23:00:00.1234568Z",
        "2024-01-02T01:00:01+02:00", "999", "1000", "9007199254740993", "9007199254740992.5", "abc",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = [r["c"] for r in df.orderBy(cursor_key(F.col("c"))).collect()]
    assert got == [
        "abc", "999", "1000", "9007199254740992.5", "9007199254740993", "2024-01-01T23:00:00Z", "2024-01-01T23:00:00.1234567Z",
        "2024-01-01T23:00:00.1234568Z", "2024-01-01T23:00:00.5Z", "2024-01-02T01:00:01+02:00",
    ]


def test_cursor_keys_compare_as_bytes(spark):
    """Families, null, empty and odd texts; equal instants and numbers have equal keys."""
    texts = [None, "", "#", "a#b#c#d", "|", "-", ".", "1e", "2024-13-99", "0", "-0.0", "00", "7", "7.0", "+7e0", "-7", "70e-1", "1e999999999999999999"]
    texts += ["2024-01-01T00:00:00Z", "2024-01-01T01:00:00+01:00", "1969-12-31T23:59:59Z"]
    rows = spark.createDataFrame([(t,) for t in texts], "c string").withColumn("k", cursor_key(F.col("c")))
    got = {r.c: (bytes(r.k), r.family, r.sign) for r in rows.select("*", key_family(F.col("k")).alias("family"), key_sign(F.col("k")).alias("sign")).collect()}
    raw = ["", "#", "a#b#c#d", "|", "-", ".", "1e", "2024-13-99", "1e999999999999999999"]
    assert got[None] == (b"", None, None) and all(got[t] == (b"\0" + t.encode(), 0, None) for t in raw)
    assert got["0"] == got["-0.0"] == got["00"] and got["0"][1:] == (1, 0)
    assert got["7"] == got["7.0"] == got["+7e0"] == got["70e-1"] and got["7"][1:] == (1, 1) and got["-7"][1:] == (1, -1)
    assert got["-7"][0] < got["0"][0] < got["7"][0] < got["1969-12-31T23:59:59Z"][0] < got["2024-01-01T00:00:00Z"][0]
    assert got["2024-01-01T00:00:00Z"] == got["2024-01-01T01:00:00+01:00"]


def test_dedup_reemits_changed_rows_and_forgets_nothing_in_reach(spark):
    df = spark.range(20_000).select("id", F.col("id").alias("c"), F.lit("a").alias("v"))
    seen = cur.remember(df, ["id"], "c", horizon=5_000)
    overlap = df.filter("c > 5000")
    assert seen.count() == 14_999 and cur.lookback_dedup(overlap, seen, ["id"]).count() == 0
    changed = overlap.withColumn("v", F.when(F.col("id") == 9_000, "b").otherwise(F.col("v")))
    assert _ids(cur.lookback_dedup(changed, seen, ["id"])) == [9_000]


def test_numbers_order_exactly(spark):
    import decimal
    import random

    rng = random.Random(1)
    texts = ["1.00000000001", "1.00000000002", "0", "-0.0", "+.5", "5.", "1e400", "-1e400", "12345678901234567890123456789012", "1E-30"]
    texts += [f"{rng.choice(['', '-', '+'])}{rng.randrange(10**rng.randrange(1, 40))}.{rng.randrange(10**rng.randrange(1, 40))}e{rng.randrange(-30, 30)}" for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "c string").withColumn("k", cursor_key(F.col("c")))
    assert df.filter(key_family(F.col("k")) != 1).count() == 0
    got = [decimal.Decimal(r["c"]) for r in df.orderBy("k").collect()]
    assert got == sorted(got)
    same = df.alias("a").join(df.alias("b"), F.col("a.k") == F.col("b.k")).select("a.c", F.col("b.c").alias("d")).collect()
    assert all(decimal.Decimal(r["c"]) == decimal.Decimal(r["d"]) for r in same)
    kept = cur.refilter_fail_open(df.select("c"), "c", "1.00000000001")
    assert {r["c"] for r in kept.collect()} == {t for t in texts if decimal.Decimal(t) > decimal.Decimal("1.00000000001")}


def test_a_cursor_type_without_floor_fails_on_null(spark):
    df = spark.createDataFrame([(1, True)], "id int, c boolean")
    assert cur.cursor_nulls(df, "c", ["id"]).count() == 1
    with pytest.raises(Exception, match="null cursor"):
        cur.cursor_nulls(spark.createDataFrame([(1, None)], "id int, c boolean"), "c", ["id"]).collect()


def test_groups_advance_independently(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2), ("c", 9)], "g string, c int")
    state = spark.createDataFrame([("a", 3), ("b", 2)], "g string, watermark int")
    got = cur.read_since_group(df, state, "g", "c", 0)
    assert sorted(map(tuple, got.collect())) == [("a", 5), ("c", 9)]
    failed = spark.createDataFrame([("c",)], "g string")
    new = cur.advance_groups(got, state, "g", "c", failed)
    assert sorted(map(tuple, new.collect())) == [("a", 5), ("b", 2)]
    assert cur.only_if_advanced(got, new, state).count() == 2
    assert cur.only_if_advanced(got, state, state).count() == 0


def test_delta_feed_needs_keys(spark):
    ok = '{"@removed":{},"@odata.id":"Set(7)"}'
    bad = '{"@removed":{},"@odata.id":"Set"}'
    df = spark.createDataFrame([(1, ok)], "pos bigint, body string")
    r = cur.delta_feed(df, "body", {"id": "bigint"}, {"v": "string"}, 3, "pos").first()
    assert (r["id"], r["v"], r["_deleted"], r["_lc_sequence"]) == (7, None, True, "000000000003000000000001")
    with pytest.raises(Exception, match="no key"):
        cur.delta_feed(spark.createDataFrame([(1, bad)], "pos bigint, body string"), "body", {"id": "bigint"}, {}, 3, "pos").collect()


def test_sparse_entries_are_refused(spark):
    make = lambda t: spark.createDataFrame([(t,)], "body string")
    assert cur.reject_sparse(make('{"a":1,"b":null}'), "body", ["a", "b"]).count() == 1
    assert cur.reject_sparse(make('{"@removed":{}}'), "body", ["a", "b"]).count() == 1
    assert cur.reject_sparse(make('{"@odata.context":"x/$link","source":1}'), "body", ["a"]).count() == 0
    for bad, word in (('{"a":1}', "sparse"), ("nope", "malformed")):
        with pytest.raises(Exception, match=word):
            cur.reject_sparse(make(bad), "body", ["a", "b"]).collect()


def test_entity_references(spark):
    cases = [
        ("Customers('ALFKI')", "id", True, "ALFKI"), ("https://h/x/Orders(OrderID=1,Lang='e''n')", "Lang", False, "e'n"),
        ("Orders(OrderID=1,Lang='en')/", "OrderID", False, "1"), ("Set(%27a%20b%27)", "id", True, "a b"),
        ("Orders(5)?$select=x", "id", True, "5"), ("Orders", "id", True, None), ("Orders(a='x')", "b", False, None),
    ]
    for ref, name, single, want in cases:
        df = spark.createDataFrame([(ref,)], "r string")
        assert df.select(entity_key_value(F.col("r"), name, single)).first()[0] == want, ref


def test_ignored_filter_is_noticed(spark):
    df = spark.createDataFrame([(1,), (2,)], "c int")
    cur.check_filter_honoured(df, "c", 1)
    with pytest.raises(RuntimeError):
        cur.check_filter_honoured(df, "c", 5)


def test_scalar_rules():
    assert cur.auto_lookback([1, 2, "x", -5, 10]) == 15 and cur.auto_lookback([9999]) == 3600 and cur.auto_lookback([]) == 0
    assert cur.no_regress(None, 3) == 3 and cur.no_regress(2, 3) == 3 and cur.no_regress(4, 3) == 4 and cur.no_regress(1, None) == 1
    assert cur.skip_if_unchanged(1, 2) and not cur.skip_if_unchanged(2, 2) and not cur.skip_if_unchanged(None, 2)
    assert cur.start_position(None, 3, 4) == 3 and cur.fence(5, 3) == 5
    assert cur.two_part_offset(None, None, (5, 1), False) == {"watermark": None, "resume": (5, 1)}
    assert cur.two_part_offset(3, (5, 1), None, True) == {"watermark": 5, "resume": None}
    assert cur.two_part_offset({"watermark": 9, "resume": None}, None, (5, 1), True)["watermark"] == 9


def test_drain_and_guard():
    steps = []

    def step(o):
        steps.append(o)
        return {"c": min(3, o["c"] + 1), "lb_x": len(steps)}

    assert drain(step, {"c": 0})[0]["c"] == 3
    with pytest.raises(RuntimeError):
        drain(lambda o: {"c": o["c"] + 1}, {"c": 0}, max_steps=5)
    progress_guard({"c": 1}, {"c": 2}, True)
    with pytest.raises(RuntimeError):
        progress_guard({"c": 1, "lb_a": 1}, {"c": 1, "lb_a": 2}, True)


def test_empty_window_still_moves(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5),)], "c timestamp_ntz")
    rows, end = cur.window_slice(df, "c", dt.datetime(2024, 1, 1), dt.timedelta(days=1), dt.datetime(2024, 1, 9))
    assert rows.count() == 0 and end == dt.datetime(2024, 1, 2)
    rows, end = cur.window_slice(df, "c", dt.datetime(2024, 1, 9), dt.timedelta(days=1), dt.datetime(2024, 1, 9))
    assert rows.count() == 0 and end == dt.datetime(2024, 1, 9)
