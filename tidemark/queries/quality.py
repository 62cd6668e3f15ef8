"""Queries of the data quality group (K)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality as q
from tidemark.plans.meta import TableMeta
from tidemark.queries import query


def _holes(t):
    return t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"), F.lit(None).cast("string").alias("never"), "o_orderdate")


@query(
    "k02_check_non_null",
    """select 'o_orderkey' as "column", count(*) filter (where o_orderkey is null) as nulls from orders
       union all select 'status', count(*) filter (where o_orderstatus = 'F') from orders union all select 'never', count(*) from orders""",
)
def k02(t):
    return q.check_non_null(_holes(t), ["o_orderkey", "status", "never"])


@query(
    "k03_check_population",
    """select * from (values ('o_orderkey', true), ('s.cust', true), ('s.never', false), ('items[].status', true), ('items[].gone', false), ('m{}', true)) v(path, filled)
       where exists (select 1 from orders)""",
)
def k03(t):
    gone = F.lit(None).cast("string")
    df = t.orders.select(
        "o_orderkey", F.struct(F.col("o_custkey").alias("cust"), gone.alias("never")).alias("s"),
        F.array(F.struct(F.col("o_orderstatus").alias("status"), gone.alias("gone"))).alias("items"), F.create_map(F.lit("a"), F.col("o_custkey")).alias("m"),
    )
    return q.check_population(df)


@query(
    "k04_check_records",
    """select count(*) as records, count(*) filter (where o_orderstatus = 'F') as misfits, cast(0 as bigint) as empty,
       count(*) filter (where o_orderstatus = 'O') as keyless from orders""",
)
def k04(t):
    price = F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    body = F.to_json(F.struct(F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")).alias("id"), price.alias("price"), F.lit("x").alias("note")))
    return q.check_records(t.orders.select(body.alias("b")), "b", T._parse_datatype_string(
        "id bigint, price double, note string"), ["id"])


@query("k05_check_pk_unique", "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1")
def k05(t):
    return q.check_pk_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


def _nested(name, inner):
    """``inner`` below eight members called ``name``."""
    for _ in range(7):
        inner = F.struct(inner.alias(name))
    return inner.alias(name)


@query(
    "k06_schema_diff",
    """select * from (values ('extra', 'undeclared'), ('s.more', 'undeclared'), ('lost', 'absent'), ('d.d.d.d.d.d.d.d.deep', 'undeclared')) v(path, side)
       where exists (select 1 from orders)""",
)
def k06(t):
    body = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("extra"), F.struct(F.col("o_custkey").alias("cust"), F.lit(1).alias("more")).alias("s"),
        F.create_map(F.col("o_orderpriority"), F.lit(1)).alias("m"), F.array(F.struct(F.lit(1).alias("n"))).alias("items"),
        _nested("d", F.struct(F.lit(1).alias("deep"), F.lit(2).alias("known"))),
    ))
    schema = T._parse_datatype_string(
        "id bigint, s struct<cust:bigint>, m map<string,int>, items array<struct<n:int>>, lost string, "
        + "d " + "struct<d:" * 7 + "struct<known:int>" + ">" * 7
    )
    return q.schema_diff(t.orders.select(body.alias("b")), "b", schema)


@query(
    "k07_shape_diff",
    """select * from (values ('price', 'float', 'str'), ('only', 'str', null), ('d.d.d.d.d.d.d.d.x', 'int', 'str')) v(path, "left", "right") where exists (select 1 from orders)""",
)
def k07(t):
    key = F.col("o_orderkey").alias("id")
    note = F.when(F.col("o_orderstatus") == "F", "x").alias("note")
    a = t.orders.select(F.to_json(F.struct(key, (F.col("o_totalprice") + 0.001).alias("price"), F.lit("x").alias("only"), note, _nested("d", F.struct(F.lit(1).alias("x")))), {"ignoreNullFields": "false"}).alias("b"))
    b = t.orders.select(F.to_json(F.struct(key, F.col("o_totalprice").cast("string").alias("price"), F.lit(None).cast("string").alias("note"), _nested("d", F.struct(F.lit("1").alias("x")))), {"ignoreNullFields": "false"}).alias("b"))
    return q.shape_diff(a, b, "b")


@query(
    "k08_reconcile",
    """select c_custkey, case when c_mktsegment = 'MACHINERY' then 'missing' else 'differs' end as problem from customer where c_mktsegment in ('MACHINERY', 'BUILDING')
       union all select c_custkey, 'delete not delivered' from customer where c_acctbal < 0 and c_mktsegment = 'FURNITURE'""",
)
def k08(t):
    from tidemark.queries.change import snapshots

    v1, v2 = snapshots(t)
    gone = v1.filter("c_acctbal < 0")
    return q.reconcile(v1, v2, ["c_custkey"], gone, gone.filter("c_mktsegment <> 'FURNITURE'"))


@query("k09_stable_read", "select count(*) as rows, true as stable from lineitem")
def k09(t):
    a = q.fingerprint(t.lineitem)
    b = q.fingerprint(q.dealt_anew(t.lineitem)).select(F.col("checksum").alias("again"))
    return a.select("rows", (F.col("checksum") == b.scalar()).alias("stable"))


@query(
    "k10_table_profile",
    """select 'primary_keys' as key, 'o_orderkey' as value union all select 'cursor_field', 'o_orderdate' union all select 'ingestion_type', 'cdc'
       union all select 'rows', cast(count(*) as varchar) from orders union all select 'nulls.o_orderkey', '0'
       union all select 'nulls.status', cast(count(*) filter (where o_orderstatus = 'F') as varchar) from orders
       union all select 'nulls.never', cast(count(*) as varchar) from orders union all select 'nulls.o_orderdate', '0'
       union all select 'cursor_min', cast(min(o_orderdate) as varchar) from orders union all select 'cursor_max', cast(max(o_orderdate) as varchar) from orders""",
)
def k10(t):
    return q.table_profile(_holes(t), TableMeta(["o_orderkey"], "o_orderdate", "cdc"))
