"""Queries of the record shaping group (F)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, shape as sh
from tidemark.functions.digest import row_digest
from tidemark.functions.keys import entity_key_value, format_entity_ref
from tidemark.queries import query

K = "cast(regexp_extract(props, '(\\d+)', 1) as bigint)"


@query("f01_flatten_paths", "select event_id, regexp_extract(props, '(\\d+)', 1) as k, cast(null as varchar) as a_b from events")
def f01(t):
    return sh.flatten_paths(t.events, "props", ["k", "a.b"], ["event_id"])


@query(
    "f02_jsonify_complex",
    """select o_orderkey, '{"status":"' || o_orderstatus || '","cust":' || o_custkey || '}' as s, '[' || o_custkey || ',' || o_orderkey || ']' as a from orders""",
)
def f02(t):
    return sh.jsonify_complex(
        t.orders.select(
            "o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust")).alias("s"),
            F.array("o_custkey", "o_orderkey").alias("a"),
        )
    )


@query(
    "f03_split_custom_props",
    f"select event_id, cast(user_id as varchar) as distinct_id, event_type as mp_lib, cast(null as varchar) as \"$city\", cast({K} as varchar) as custom_k, cast(1 as bigint) as custom_n from events",
)
def f03(t):
    body = F.to_json(F.struct(F.col("user_id").alias("distinct_id"), F.col("event_type").alias("mp_lib"), F.get_json_object("props", "$.k").alias("k")))
    out = sh.split_custom_props(t.events.select("event_id", body.alias("b")), "b", ["distinct_id", "mp_lib", "$city"], keep=["event_id"])
    return out.select(
        "event_id", "distinct_id", "mp_lib", "$city", F.col("custom_properties").getItem("k").alias("custom_k"),
        F.size("custom_properties").cast("bigint").alias("custom_n"),
    )


@query("f04_pad_to_schema", "select c_custkey, c_name, cast(null as varchar) as phone, cast(null as date) as since from customer")
def f04(t):
    schema = T._parse_datatype_string("c_custkey bigint, c_name string, phone string, since date")
    return sh.pad_to_schema(t.customer.select("c_name", "c_custkey"), schema, ["c_custkey"])


@query("f05_empty_to_null", "select o_orderkey, nullif(o_orderstatus, 'F') as status, nullif(o_orderstatus, 'O') as in_map from orders")
def f05(t):
    blank = lambda x: F.when(F.col("o_orderstatus") == x, "").otherwise(F.col("o_orderstatus"))
    df = t.orders.select("o_orderkey", blank("F").alias("status"), F.create_map(F.lit("m"), blank("O")).alias("m"))
    return sh.empty_to_null(df).select("o_orderkey", "status", F.col("m").getItem("m").alias("in_map"))


@query(
    "f06_empty_struct_to_null",
    "select o_orderkey, o_orderstatus = 'F' as outer_null, o_orderstatus <> 'P' as inner_null from orders",
)
def f06(t):
    s = F.col("o_orderstatus")
    nested = F.struct(F.when(s == "O", F.lit(1)).alias("a"), F.struct(F.when(s == "P", F.lit("x")).alias("b")).alias("n"))
    df = t.orders.select("o_orderkey", nested.alias("s"))
    fixed = sh.empty_struct_to_null(F.col("s"), df.schema["s"].dataType)
    return df.select("o_orderkey", fixed.alias("s")).select("o_orderkey", F.col("s").isNull().alias("outer_null"), F.col("s.n").isNull().alias("inner_null"))


@query(
    "f07_strip_meta_keys",
    """select o_orderkey, '{"key":' || o_orderkey || ',"nested":{"nested":{"nested":{"nested":{"nested":{"nested":{"nested":{"status":"' || o_orderstatus
       || '"}}}}}}}}' as body from orders""",
)
def f07(t):
    # seven entities, each inside the one before
    raw = F.concat(
        F.lit('{"__metadata":{"uri":"u"},"key":'), F.col("o_orderkey").cast("string"), F.lit(',"key@type":"long","items":{"__deferred":{"uri":"u"}}'),
        F.lit(',"nested":{"__metadata":{}' * 7), F.lit(',"status":"'), F.col("o_orderstatus"), F.lit('"' + "}" * 8),
    )
    return t.orders.select("o_orderkey", sh.strip_meta_keys(raw, sh.json_depth(t.orders, raw)).alias("body"))


@query(
    "f08_snake_case_keys",
    "select o_orderkey as order_key, o_orderstatus as order_status, o_custkey as customer_id, o_orderpriority as http_priority from orders",
)
def f08(t):
    df = t.orders.select(
        F.col("o_orderkey").alias("orderKey"), F.struct(F.col("o_orderstatus").alias("orderStatus")).alias("TheDetail"),
        F.create_map(F.lit("customerID"), F.col("o_custkey")).alias("extraKeys"), F.col("o_orderpriority").alias("HTTPPriority"),
    )
    out = sh.snake_case_keys(df)
    return out.select("order_key", "the_detail.order_status", F.col("extra_keys").getItem("customer_id").alias("customer_id"), "http_priority")


@query(
    "f10_header_row_to_columns",
    """select cast(c_custkey + 2 as varchar) as row_index, cast(c_custkey as varchar) as Customer_Key, c_name as _col1,
       case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end as Segment from customer""",
)
def f10(t):
    head = t.spark.createDataFrame([(0, ["Customer Key", "", "Segment!"])], "pos bigint, cells array<string>")
    full = F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    cells = F.when(F.col("c_mktsegment") == "BUILDING", F.slice(full, 1, 2)).otherwise(full)
    sheet = head.unionByName(t.customer.select((F.col("c_custkey") + 1).alias("pos"), cells.alias("cells")))
    return sh.header_row_to_columns(sheet, "pos", "cells")


@query("f11_zip_headers", "select o_orderkey, o_orderstatus as status, o_orderpriority as priority, cast(null as varchar) as other from orders")
def f11(t):
    df = t.orders.select(
        "o_orderkey", F.array(F.lit("priority"), F.lit("status")).alias("h"), F.array("o_orderpriority", "o_orderstatus").alias("v")
    )
    return sh.zip_headers(df, "h", "v", ["status", "priority", "other"], ["o_orderkey"])


@query(
    "f12_series_matrix_to_rows",
    """select strftime(ts, '%Y-%m-%d') as date, case when event_type = 'view' then 'Totals' else event_type end as segment, cast(count(*) as double) as value
       from events group by 1, event_type""",
)
def f12(t):
    # one report body per event type, as an upstream report service would return it
    n = t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    lists = n.groupBy("event_type").agg(F.array_sort(F.collect_list(F.struct("d", "n"))).alias("l"))
    meta = F.when(F.col("event_type") == "view", F.lit('[{"segmentIndex":0}]')).otherwise(F.concat(F.lit('["'), F.col("event_type"), F.lit('"]')))
    body = F.concat(
        F.lit('{"data":{"series":['), F.to_json(F.transform("l", lambda x: x["n"])), F.lit('],"xValues":'),
        F.to_json(F.transform("l", lambda x: x["d"])), F.lit(',"seriesMeta":'), meta, F.lit("}}"),
    )
    return sh.series_matrix_to_rows(lists.select(body.alias("b")), "b")


def _answers(t):
    body = F.to_json(
        F.struct(
            F.struct(F.lit("x").alias("choiceText"), F.col("o_orderstatus").alias("choiceId")).alias("QID1"),
            F.col("o_orderpriority").alias("QID2"), F.struct(F.lit("done").alias("textEntry")).alias("status"),
        )
    )
    return t.orders.select("o_orderkey", F.from_json(body, "map<string,variant>").alias("m"))


@query(
    "f13_normalize_answers",
    """select o_orderkey, 'x' as text1, o_orderstatus as id1, o_orderpriority as entry2, cast(2 as bigint) as n from orders""",
)
def f13(t):
    df = _answers(t).select("o_orderkey", sh.normalize_answers(F.col("m"), ["status"]).alias("a"))
    a = F.col("a")
    return df.select(
        "o_orderkey", a["QID1"]["choiceText"].alias("text1"), a["QID1"]["choiceId"].alias("id1"),
        a["QID2"]["textEntry"].alias("entry2"), F.size("a").cast("bigint").alias("n"),
    )


@query("f14_coalesce_from_map", "select o_orderkey, case when o_orderstatus = 'F' then 'F' else 'done' end as status from orders")
def f14(t):
    top = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("status"), *[
        sh.normalize_answers(F.from_json(F.lit('{"status":{"textEntry":"done"}}'), "map<string,variant>"), []).alias("a")])
    return top.select("o_orderkey", sh.coalesce_from_map(F.col("status"), F.col("a"), "status").alias("status"))


@query(
    "f15_association_ids",
    "select o_orderkey, cast(o_custkey as varchar) || ',7' as companies, '' as deals from orders",
)
def f15(t):
    body = F.concat(F.lit('{"associations":{"companies":{"results":[{"id":"'), F.col("o_custkey").cast("string"), F.lit('"},{"id":7}]}}}'))
    cols = sh.association_ids(F.col("b"), ["companies", "deals"])
    out = t.orders.select("o_orderkey", body.alias("b")).select("o_orderkey", *cols)
    return out.select("o_orderkey", *[F.array_join(c, ",").alias(c) for c in ("companies", "deals")])


@query(
    "f16_links_to_rows",
    """select 'order' as entity, o_orderkey as id, 'self' as rel, 'o/' || o_orderkey as href from orders
       union all select 'order', o_orderkey, 'customer', 'c/' || o_custkey from orders where o_orderstatus <> 'F'""",
)
def f16(t):
    m = F.create_map(
        F.lit("self"), F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")),
        F.lit("customer"), F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("c/"), F.col("o_custkey").cast("string"))),
    )
    return sh.links_to_rows(t.orders.select("o_orderkey", m.alias("l")), "order", "o_orderkey", "l")


@query(
    "f17_hoist",
    "select o_orderkey, o_orderstatus as status, 'orders/' || o_orderkey || '/cust/' || o_custkey as url, 'shop' as source from orders",
)
def f17(t):
    df = t.orders.select("o_orderkey", F.struct("o_custkey", F.struct("o_orderstatus").alias("d")).alias("n"))
    out = sh.hoist(
        df, {"status": "n.d.o_orderstatus"},
        {"url": ["orders/", F.col("o_orderkey").cast("string"), "/cust/", F.col("n.o_custkey").cast("string")]}, {"source": "shop"},
    )
    return out.drop("n")


@query(
    "f18_date_dialects",
    """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ms_date, make_timestamp((epoch_us(ts) // 1000) * 1000) as from_ms,
       cast(ts as date) as compact, timestamp '2024-02-01' - to_hours(cast(user_id as int)) as relative, timestamp '2024-02-01' as now from events""",
)
def f18(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    now = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp")
    rel = F.concat(F.lit("*-"), F.col("user_id").cast("string"), F.lit("h"))
    return t.events.select(
        "event_id", dates.ms_date_to_iso(F.concat(F.lit("/Date("), ms.cast("string"), F.lit("+0000)/"))).alias("ms_date"),
        dates.epoch_ms(ms).cast("timestamp_ntz").alias("from_ms"), dates.compact_date(F.date_format("ts", "yyyyMMdd")).alias("compact"),
        dates.relative_time(rel, now).cast("timestamp_ntz").alias("relative"), dates.relative_time(F.lit("*"), now).cast("timestamp_ntz").alias("now"),
    )


@query(
    "f19_kind_dispatch",
    """select event_id, event_type as kind, case when event_type = 'purchase' then value end as amount,
       case when event_type in ('view', 'click') then user_id end as visitor from events""",
)
def f19(t):
    layouts = {
        "purchase": {"amount": F.col("value")}, "view": {"visitor": F.col("user_id")}, "click": {"visitor": F.col("user_id")},
    }
    return sh.kind_dispatch(t.events, "event_type", layouts, {"event_id": F.col("event_id"), "kind": F.col("event_type")})


@query(
    "f20_as_string_list",
    """select o_orderkey, case when o_orderstatus = 'F' then cast(o_custkey as varchar) else o_custkey || '|' || o_orderstatus end as items,
       case when o_orderstatus = 'F' then '' else o_orderstatus end as m from orders""",
)
def f20(t):
    lost = F.col("o_orderstatus") == "F"
    cust = F.col("o_custkey").cast("string")
    text = F.when(lost, cust).otherwise(F.concat(F.lit("["), cust, F.lit(',"'), F.col("o_orderstatus"), F.lit('"]')))
    m = F.create_map(F.lit("s"), F.when(~lost, F.col("o_orderstatus")))
    df = t.orders.select("o_orderkey", F.parse_json(text).alias("v"), m.alias("m"))
    return df.select("o_orderkey", F.array_join(sh.as_string_list(F.col("v")), "|").alias("items"), sh.map_strings(F.col("m")).getItem("s").alias("m"))


@query(
    "f21_singleton_row",
    "select cast(1 as bigint) as id, min(o_orderdate) as first_day, count(*) as orders from orders having count(*) > 0",
)
def f21(t):
    one = t.orders.agg(F.min("o_orderdate").alias("first_day"), F.count(F.lit(1)).alias("orders"))
    return sh.singleton_row(one, ["first_day"])


@query(
    "f22_position_index",
    "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as position from orders",
)
def f22(t):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return sh.position_index(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "f23_redact_emails",
    f"select doc_id, sha256(regexp_replace(text, '{sh.EMAIL}', '{sh.REDACTED_EMAIL}', 'g')) as digest, regexp_matches(text, '{sh.EMAIL}') as found from documents",
)
def f23(t):
    text = F.col("text")
    return t.documents.select("doc_id", F.sha2(sh.redact_emails(text), 256).alias("digest"), sh.has_email(text).alias("found"))


@query("f23_redact_headers", "select event_id, 'REDACTED' as cookie, event_type as kind from events")
def f23_headers(t):
    m = F.create_map(F.lit("Set-Cookie"), F.col("user_id").cast("string"), F.lit("Kind"), F.col("event_type"))
    out = t.events.select("event_id", sh.redact_headers(m, ["set-cookie"]).alias("h"))
    return out.select("event_id", F.col("h").getItem("Set-Cookie").alias("cookie"), F.col("h").getItem("Kind").alias("kind"))


@query(
    "f24_row_digest",
    """select o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority
       || '","o_orderstatus":' || case when o_orderstatus = 'F' then 'null' else '"' || o_orderstatus || '"' end || '}') as digest from orders""",
)
def f24(t):
    df = t.orders.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"), "o_orderpriority")
    return df.select("o_orderkey", row_digest(df.columns).alias("digest"))


@query("f25_parse_entity_key", "select o_orderkey, cast(o_custkey as varchar) as cust, o_orderpriority || '''s' as prio, cast(o_orderkey as varchar) as bare from orders")
def f25(t):
    quoted = F.concat(F.col("o_orderpriority"), F.lit("'s"))
    ref = F.concat(F.lit("https://h/svc/"), F.replace(format_entity_ref("Orders", {"cust": F.col("o_custkey"), "prio": quoted}, {"prio"}), F.lit(" "), F.lit("%20")))
    bare = F.concat(F.lit("Orders('"), F.col("o_orderkey").cast("string"), F.lit("')?x=1"))
    return t.orders.select(
        "o_orderkey", entity_key_value(ref, "cust", False).alias("cust"), entity_key_value(ref, "prio", False).alias("prio"),
        entity_key_value(bare, "id", True).alias("bare"),
    )


@query(
    "f26_rename_map",
    """select o_orderkey as id, o_orderpriority as name, cast(null as varchar) as description, o_orderstatus = 'F' as archived,
       o_orderdate as created, cast(null as varchar) as url, o_orderstatus = 'O' as allowed_actions_can_modify, cast(null as boolean) as allowed_actions_can_delete from orders""",
)
def f26(t):
    body = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), (F.col("o_orderstatus") == "F").alias("archived"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("created"),
        F.struct((F.col("o_orderstatus") == "O").alias("canModify")).alias("allowedActions"),
    ))
    out = sh.time_tracking_rows(t.orders.select(body.alias("b")), "b", "customers")
    return out.withColumn("created", F.col("created").cast("timestamp_ntz"))


@query(
    "f27_indexed_rows",
    """select o_orderkey, cast(0 as bigint) as row_index, case when o_orderstatus = 'F' then '' else o_orderstatus end as status from orders
       union all select o_orderkey, o_custkey, o_orderpriority from orders""",
)
def f27(t):
    row = lambda i, v: F.struct(i.alias("Index"), F.create_map(F.lit("status"), v).alias("Columns"))
    items = F.array(
        row(F.lit(None).cast("bigint"), F.nullif("o_orderstatus", F.lit("F"))), row(F.col("o_custkey"), F.col("o_orderpriority"))
    )
    out = sh.indexed_rows(t.orders.select("o_orderkey", items.alias("i")), "o_orderkey", "i")
    return out.select("o_orderkey", "row_index", F.col("columns").getItem("status").alias("status"))


@query(
    "f28_attribute_rows",
    """select o_orderkey, 'status' as name, o_orderstatus as value, 'String' as type from orders
       union all select o_orderkey, 'cust', cast(o_custkey as varchar), 'Int64' from orders""",
)
def f28(t):
    attr = lambda n, v, k: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"), F.lit(k).alias("type"))
    attrs = F.array(attr("status", F.col("o_orderstatus"), "String"), attr("cust", F.col("o_custkey"), "Int64"))
    return sh.attribute_rows(t.orders.select("o_orderkey", attrs.alias("a")), "o_orderkey", "a")
