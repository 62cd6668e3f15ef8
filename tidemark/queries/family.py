"""Queries of the parent/child group (H)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import family as fm
from tidemark.queries import query


@query(
    "h01_fan_out",
    "select o_orderkey, o_orderdate, l_linenumber, l_partkey, l_quantity from orders join lineitem on l_orderkey = o_orderkey",
)
def h01(t):
    kids = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return fm.fan_out(t.orders, kids, {"o_orderkey": "l_orderkey"}, ["o_orderkey", "o_orderdate"]).drop("l_orderkey")


@query(
    "h02_tag_ancestor_fks",
    """select o_orderkey, o_custkey, r_regionkey as region_r_regionkey, n_nationkey as nation_n_nationkey, c_custkey as customer_c_custkey
       from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey""",
)
def h02(t):
    levels = [
        {"segment": "region", "df": t.region, "keys": ["r_regionkey"]},
        {"segment": "nation", "df": t.nation, "keys": ["n_nationkey"], "link": {"r_regionkey": "n_regionkey"}},
        {"segment": "customer", "df": t.customer, "keys": ["c_custkey"], "link": {"n_nationkey": "c_nationkey"}},
    ]
    return fm.tag_ancestor_fks(levels, t.orders.select("o_orderkey", "o_custkey"), {"c_custkey": "o_custkey"})


def _nested(t):
    """Lines as documents with a list of what they refer to; each child has its own key."""
    child = lambda n, c: F.struct(F.lit(n).alias("kind"), F.col(c).alias("ref"))
    kids = F.when(F.col("l_returnflag") == "N", F.array(child("part", "l_partkey"))).when(
        F.col("l_returnflag") == "R", F.array(child("part", "l_partkey"), child("supplier", "l_suppkey"))
    ).otherwise(F.slice(F.array(child("part", "l_partkey")), 1, 0))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.lit("line").alias("kind"), kids.alias("kids"))


@query(
    "h03_explode_children",
    """select l_orderkey, l_linenumber, l_quantity, 'part' as kind, l_partkey as ref from lineitem where l_returnflag in ('N', 'R')
       union all select l_orderkey, l_linenumber, l_quantity, 'supplier', l_suppkey from lineitem where l_returnflag = 'R'""",
)
def h03(t):
    return fm.explode_children(_nested(t), "kids", ["l_orderkey", "l_linenumber", "l_quantity"])


@query(
    "h04_explode_filtered_children",
    "select l_orderkey, l_linenumber, 'supplier' as kind, l_suppkey as ref from lineitem where l_returnflag = 'R'",
)
def h04(t):
    return fm.explode_filtered_children(_nested(t), "kids", ["l_orderkey", "l_linenumber", "kind"], lambda x: x["kind"] == "supplier")


@query(
    "h05_junction",
    """select p_partkey || '_' || s_suppkey as _junction_id, p_partkey, s_suppkey from
       (select distinct l_partkey p_partkey, l_suppkey s_suppkey, l_orderkey k from lineitem)""",
)
def h05(t):
    link = F.struct("l_orderkey", "l_partkey", "l_suppkey").alias("link")
    parts = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), link).distinct()
    suppliers = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), link).distinct()
    return fm.junction(parts, suppliers, "link", "p_partkey", "s_suppkey")


@query(
    "h06_changed_parents_only",
    """select l_orderkey, l_linenumber, l_quantity from lineitem where l_orderkey in
       (select o_orderkey from orders where o_orderdate > timestamp '2000-06-01')""",
)
def h06(t):
    kids = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return fm.changed_parents_only(kids, t.orders, {"o_orderkey": "l_orderkey"}, "o_orderdate", dt.datetime(2000, 6, 1))


@query(
    "h07_ancestor_cursor",
    """select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'R' then l_shipdate else o_orderdate end as cursor
       from lineitem join orders on o_orderkey = l_orderkey""",
)
def h07(t):
    own = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    kids = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", own.alias("own"))
    return fm.ancestor_cursor(kids, t.orders, {"o_orderkey": "l_orderkey"}, "o_orderdate", "cursor", "own").drop("own")


@query(
    "h08_flatten_expand",
    """select n_nationkey as l0_n_nationkey, c_custkey as l1_c_custkey, o_orderkey, o_totalprice from nation
       join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey""",
)
def h08(t):
    # documents as an expanded read returns them: nation -> customers -> orders
    orders = F.array(F.struct("o_orderkey", "o_totalprice")).alias("orders")
    doc = (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_nationkey", F.array(F.struct("c_custkey", orders)).alias("customers"))
    )
    return fm.flatten_expand(doc, [("customers", ["n_nationkey"]), ("orders", ["c_custkey"])])


@query(
    "h09_hierarchy",
    """with x as (select r_regionkey r, n_nationkey n, c_custkey c, o_orderkey o from region join nation on n_regionkey = r_regionkey
         join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey)
       select 'R' || r_regionkey as id, 'R' || r_regionkey as root, 0 as depth, 'R' || r_regionkey as path, false as cycle from region
       union all select 'N' || n_nationkey, 'R' || n_regionkey, 1, 'R' || n_regionkey || '/N' || n_nationkey, false from nation
       union all select 'C' || c_custkey, 'R' || n_regionkey, 2, 'R' || n_regionkey || '/N' || n_nationkey || '/C' || c_custkey, false
         from customer join nation on c_nationkey = n_nationkey
       union all select 'L' || k, 'L0', cast(k as integer), (select string_agg('L' || j, '/' order by j) from range(0, k + 1) r(j)), false from range(0, 40) l(k)
       union all select 'Z' || k, null, null, null, true from range(0, 3) z(k)
       union all select 'O' || o, 'R' || r, 3, 'R' || r || '/N' || n || '/C' || c || '/O' || o, false from x""",
)
def h09(t):
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nodes = (
        t.region.select(name("R", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"))
        .unionByName(t.nation.select(name("N", "n_nationkey").alias("id"), name("R", "n_regionkey").alias("parent")))
        .unionByName(t.customer.select(name("C", "c_custkey").alias("id"), name("N", "c_nationkey").alias("parent")))
        .unionByName(t.orders.select(name("O", "o_orderkey").alias("id"), name("C", "o_custkey").alias("parent")))
    )
    # a chain of forty, and a ring of two with a node that leads into it
    line = t.spark.range(40).select(name("L", "id").alias("id"), F.when(F.col("id") > 0, F.concat(F.lit("L"), (F.col("id") - 1).cast("string"))).alias("parent"))
    ring = t.spark.range(3).select(name("Z", "id").alias("id"), F.concat(F.lit("Z"), (F.col("id") % 2 + F.when(F.col("id") < 2, F.lit(1) - 2 * (F.col("id") % 2)).otherwise(0)).cast("string")).alias("parent"))
    nodes = nodes.unionByName(line).unionByName(ring)
    # orders whose customer is not in the list would be roots of their own
    real = nodes.join(nodes.select(F.col("id").alias("parent")), "parent", "left_semi").unionByName(nodes.filter("parent is null"))
    return fm.hierarchy(real, "id", "parent")


@query(
    "h10_union_groups",
    """select o_orderkey, o_totalprice, 'open' as source_id from orders where o_orderstatus = 'O'
       union all select o_orderkey, o_totalprice, 'closed' from orders where o_orderstatus = 'F'""",
)
def h10(t):
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return fm.union_groups({
        "open": o.filter("o_orderstatus = 'O'").drop("o_orderstatus"), "closed": o.filter("o_orderstatus = 'F'").drop("o_orderstatus"),
    })


@query(
    "h11_cohort_members",
    "select distinct event_type as cohort, user_id as distinct_id from events where event_type in ('purchase', 'error')",
)
def h11(t):
    cohorts = t.events.select(F.col("event_type").alias("cohort")).distinct().filter("cohort in ('purchase', 'error')")
    return fm.cohort_members(cohorts, t.events.select(F.col("event_type").alias("cohort"), F.col("user_id").alias("distinct_id")).distinct(), "cohort")


@query(
    "h12_skip_vanished",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem
       where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P')""",
)
def h12(t):
    kids = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return fm.skip_vanished(kids, t.orders.filter("o_orderstatus <> 'P'"), {"o_orderkey": "l_orderkey"})[0]


@query("h12_skipped_count", "select count(*) as skipped from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')")
def h12_count(t):
    return fm.skip_vanished(t.lineitem.select("l_orderkey"), t.orders.filter("o_orderstatus <> 'P'"), {"o_orderkey": "l_orderkey"})[1]


@query(
    "h13_fill_from_parent",
    """select o_orderkey, o_custkey, coalesce(case when o_orderstatus = 'F' then 'own' end, c_mktsegment) as segment, 'shop' as source_name
       from orders join customer on o_custkey = c_custkey""",
)
def h13(t):
    kids = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", "own").alias("segment"))
    parents = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return fm.fill_from_parent(kids, parents, {"c_custkey": "o_custkey"}, ["segment"], "shop")


@query(
    "h14_enrich_or_fallback",
    """select c.c_custkey, coalesce(d.c_name, c.c_name) as c_name, case when d.c_custkey is not null then d.bal else c.c_acctbal end as c_acctbal,
       d.orders, d.c_custkey is not null as detailed from customer c left join
       (select c_custkey, upper(c_name) c_name, c_acctbal + 1 bal, count(*) orders from customer join orders on o_custkey = c_custkey
        where c_mktsegment = 'BUILDING' group by 1, 2, 3) d on d.c_custkey = c.c_custkey""",
)
def h14(t):
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    detail = t.customer.filter("c_mktsegment = 'BUILDING'").join(n, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"), "orders"
    )
    return fm.enrich_or_fallback(t.customer.select("c_custkey", "c_name", "c_acctbal"), detail, "c_custkey", ["c_name", "c_acctbal", "orders"])
