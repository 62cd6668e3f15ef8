"""Queries of the coercion group (E): tables rendered as raw text, coerced back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import coerce as co
from tidemark.queries import query

MONEY = "decimal(18,2)"


def _typed(t, body, kind: str, key="o_orderkey", table="orders"):
    """(key, v, bad): the JSON value ``body`` of every row coerced to ``kind``."""
    schema = T.StructType().add("v", T._parse_datatype_string(kind))
    df = getattr(t, table).select(key, F.to_json(F.struct(body.alias("v"))).alias("body"))
    out = co.coerce(df, "body", schema, "quarantine", [key])
    return out.select(key, "v", (F.size(co.ERRORS) > 0).alias("bad"))


@query(
    "e01_string",
    """select o_orderkey, case o_orderstatus when 'F' then cast(o_custkey as varchar)
       when 'O' then '{"p":"' || o_orderpriority || '"}' else o_orderpriority end as v, false as bad from orders""",
)
def e01(t):
    raw = F.when(F.col("o_orderstatus") == "F", F.to_json(F.struct(F.col("o_custkey").alias("v")))).when(
        F.col("o_orderstatus") == "O", F.to_json(F.struct(F.struct(F.col("o_orderpriority").alias("p")).alias("v")))
    ).otherwise(F.to_json(F.struct(F.col("o_orderpriority").alias("v"))))
    df = t.orders.select("o_orderkey", raw.alias("body"))
    out = co.coerce(df, "body", T.StructType().add("v", "string"), "quarantine", ["o_orderkey"])
    return out.select("o_orderkey", "v", (F.size(co.ERRORS) > 0).alias("bad"))


@query(
    "e02_long",
    """select o_orderkey, case when o_orderstatus = 'F' then null else cast(trunc(o_totalprice) as bigint) end as v,
       o_orderstatus = 'F' as bad from orders""",
)
def e02(t):
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    return _typed(t, F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(price), "bigint")


@query("e03_double", "select o_orderkey, o_totalprice as v, false as bad from orders")
def e03(t):
    price = F.col("o_totalprice").cast(MONEY).cast("string")
    sci = F.concat((F.col("o_totalprice").cast(MONEY) * 100).cast("bigint").cast("string"), F.lit("e-2"))
    return _typed(t, F.when(F.col("o_orderstatus") == "F", sci).otherwise(price), "double")


@query("e04_decimal", "select o_orderkey, cast(o_totalprice as decimal(18,2)) as v, false as bad from orders")
def e04(t):
    return _typed(t, F.col("o_totalprice").cast(MONEY).cast("string"), "decimal(18,2)")


@query(
    "e05_boolean",
    "select o_orderkey, o_orderstatus <> 'F' as v, false as bad from orders",
)
def e05(t):
    # F is a false word; O and P are unknown texts and therefore true
    return _typed(t, F.col("o_orderstatus"), "boolean")


@query(
    "e06_date",
    """select o_orderkey, case when o_orderpriority <> '5-LOW' then cast(o_orderdate as date) end as v, o_orderpriority = '5-LOW' as bad from orders""",
)
def e06(t):
    d, p = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(p == "1", F.date_format(d, "yyyy-MM-dd")).when(p == "2", F.date_format(d, "MM/dd/yyyy"))
        .when(p == "3", F.date_format(d, "dd-MM-yyyy")).when(p == "4", F.date_format(d, "yyyy/MM/dd"))
        .otherwise(F.lit("soon"))
    )
    return _typed(t, text, "date")


@query(
    "e07_timestamp",
    """select event_id, case event_type when 'purchase' then null when 'signup' then date_trunc('second', ts) else ts end as v, event_type = 'purchase' as bad from events""",
)
def e07(t):
    ts, k = F.col("ts"), F.col("event_type")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = (
        F.when(k == "view", F.concat(F.date_format(ts, iso), F.lit("Z")))
        .when(k == "click", F.concat(F.date_format(ts + F.expr("interval 5 hours"), iso), F.lit("+05:00")))
        .when(k == "error", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(k == "signup", F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .otherwise(F.lit("yesterday"))
    )
    out = _typed(t, text, "timestamp", "event_id", "events")
    return out.withColumn("v", F.col("v").cast("timestamp_ntz"))


@query("e08_binary", "select doc_id, sha256(text) as digest, strlen(text) as bytes from documents")
def e08(t):
    df = t.documents.select("doc_id", F.to_json(F.struct(F.base64(F.encode("text", "UTF-8")).alias("v"))).alias("body"))
    out = co.coerce(df, "body", T.StructType().add("v", "binary"), "strict", ["doc_id"])
    return out.select("doc_id", F.sha2("v", 256).alias("digest"), F.octet_length("v").cast("bigint").alias("bytes"))


@query(
    "e09_struct",
    """select o_orderkey, o_custkey as cust, o_orderpriority as priority, cast(null as varchar) as missing, cast(o_orderdate as date) as day from orders""",
)
def e09(t):
    body = F.to_json(F.struct("o_orderkey", F.struct(F.col("o_custkey").cast("string").alias("cust"), F.struct(
        F.col("o_orderpriority").alias("priority"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("day")).alias("more")).alias("s")))
    schema = T._parse_datatype_string("o_orderkey bigint, s struct<cust:bigint,more:struct<priority:string,day:date,missing:string>>")
    out = co.coerce(t.orders.select(body.alias("body")), "body", schema)
    return out.select("o_orderkey", "s.cust", "s.more.priority", "s.more.missing", "s.more.day")


@query(
    "e10_array",
    """select o_orderkey, case when o_orderstatus = 'F' then cast(o_custkey as varchar) else o_custkey || ',' || o_orderkey end as v, false as bad from orders""",
)
def e10(t):
    one = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("v")))
    two = F.to_json(F.struct(F.array(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("v")))
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", one).otherwise(two).alias("body"))
    out = co.coerce(df, "body", T._parse_datatype_string("v array<bigint>"), "quarantine", ["o_orderkey"])
    return out.select("o_orderkey", F.array_join(F.col("v").cast("array<string>"), ",").alias("v"), (F.size(co.ERRORS) > 0).alias("bad"))


@query("e11_map", "select o_orderkey, o_custkey as a, cast(trunc(o_totalprice) as bigint) as b from orders")
def e11(t):
    m = F.create_map(F.lit("a"), F.col("o_custkey").cast("string"), F.lit("b"), F.col("o_totalprice").cast(MONEY).cast("string"))
    out = _typed(t, m, "map<string,bigint>")
    return out.select("o_orderkey", F.col("v").getItem("a").alias("a"), F.col("v").getItem("b").alias("b"))


@query("e12_variant", "select event_id, cast(regexp_extract(props, '(\\d+)', 1) as bigint) as k from events")
def e12(t):
    out = _typed(t, F.col("props"), "variant", "event_id", "events")
    return out.select("event_id", F.variant_get("v", "$.k", "bigint").alias("k"))


@query(
    "e13_metric_value",
    """select o_orderkey, o_custkey as whole, o_totalprice as amount, o_orderpriority as label,
       cast(null as bigint) as misfit from orders""",
)
def e13(t):
    o = t.orders
    return o.select(
        "o_orderkey", co.metric_value(F.col("o_custkey").cast("string"), "TYPE_INTEGER").alias("whole"),
        co.metric_value(F.col("o_totalprice").cast(MONEY).cast("string"), "TYPE_CURRENCY").alias("amount"),
        co.metric_value(F.col("o_orderpriority"), "TYPE_TEXT").alias("label"),
        co.metric_value(F.col("o_orderpriority"), "TYPE_INTEGER").alias("misfit"),
    )


@query(
    "e14_lenient",
    """select o_orderkey, case when o_orderstatus <> 'F' then o_totalprice end as amount, o_orderstatus = 'P' as flag,
       case when o_orderstatus <> 'F' then o_custkey end as whole from orders""",
)
def e14(t):
    lost = F.col("o_orderstatus") == "F"
    word = F.when(F.col("o_orderstatus") == "P", " Yes ").when(lost, "F").otherwise("unsure")
    return t.orders.select(
        "o_orderkey",
        co.try_float(F.when(lost, "").otherwise(F.col("o_totalprice").cast(MONEY).cast("string"))).alias("amount"),
        co.as_bool(word).alias("flag"),
        co.try_long(F.when(lost, F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))).alias("whole"),
    )
