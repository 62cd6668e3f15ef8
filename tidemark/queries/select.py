"""Queries of the predicate and paging group (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import select as sl
from tidemark.queries import query

O3 = ["o_orderkey", "o_orderstatus", "o_totalprice"]


@query(
    "g01_filter_ops",
    """select o_orderkey, o_orderstatus, o_totalprice from orders where o_totalprice >= 100000 and o_totalprice < 300000.5
       and o_orderpriority in ('1-URGENT', '5-LOW') and o_orderstatus <> 'F' and o_custkey > 100""",
)
def g01(t):
    return sl.filter_ops(
        t.orders,
        [("o_totalprice", "GTE", "100000"), ("o_totalprice", "LT", "300000.5"), ("o_orderpriority", "IN", "1-URGENT, 5-LOW"),
         ("o_orderstatus", "NE", "F"), ("o_custkey", "GT", "100")],
    ).select(*O3)


@query("g01_null_and_misfit", "select c_custkey, case when c_acctbal > 0 then c_acctbal end as c_acctbal from customer where c_acctbal <= 0 or c_acctbal <> 1863.84")
def g01_null(t):
    df = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"))
    kept = sl.filter_ops(df, [("c_acctbal", "NE", "1863.84")])
    # an operand that is no number matches nothing
    return kept.unionByName(sl.filter_ops(df, [("c_acctbal", "GT", "abc")]))


@query("g02_equality_options", "select event_id, user_id, event_type from events where event_type = 'purchase' and user_id = 7")
def g02(t):
    df = t.events.select("event_id", "user_id", "event_type")
    return sl.equality_options(df, {"event_type": "purchase", "user_id": "7", "status": "", "lookback": "5"}, ["event_type", "user_id", "status"])


@query(
    "g03_sort_nulls",
    """select o_orderkey, case when o_orderstatus <> 'F' then o_totalprice end as bal from orders
       order by bal desc nulls first, o_orderkey""",
)
def g03(t):
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("bal"))
    return sl.sort_nulls(df, "bal", "desc", ["o_orderkey"])


@query("g04_page_offset", "select o_orderkey, o_orderdate from orders order by o_orderdate, o_orderkey limit 100 offset 250")
def g04(t):
    return sl.page_offset(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 250, 100)


@query(
    "g04_page_number",
    """select event_id, ts, (select count(*) from events) > 150 as next_page from events order by ts, event_id limit 50 offset 100""",
)
def g04_page(t):
    return sl.page_number(t.events.select("event_id", "ts"), ["ts", "event_id"], 3, 50)


@query("g05_select_columns", "select o_orderkey, o_orderdate, o_orderstatus from orders")
def g05(t):
    return sl.select_columns(t.orders, ["o_orderkey", "o_orderdate", "o_orderstatus"], ["o_orderkey"], "o_orderdate")


@query(
    "g06_filters_at",
    """select n_nationkey, c_custkey from nation join customer on c_nationkey = n_nationkey
       where (n_regionkey = 1 or n_regionkey = 2) and (c_acctbal > 0) and (c_mktsegment = 'BUILDING')""",
)
def g06(t):
    by_level = sl.parse_filters_at('{"nations": "n_regionkey = 1 OR n_regionkey = 2", "customers": "c_acctbal < 0", "1": "c_acctbal > 0"}', ["nations", "customers"])
    n = sl.filter_level(t.nation, by_level.get(0))
    c = sl.filter_level(t.customer, by_level.get(1), "c_mktsegment = 'BUILDING'")
    return n.join(c, n.n_nationkey == c.c_nationkey).select("n_nationkey", "c_custkey")


@query("g07_search_names", "select p_partkey, p_name from part where regexp_matches(p_name, '^(red|blue) .*t$')")
def g07(t):
    return sl.search_names(t.part.select("p_partkey", "p_name"), "p_name", "^(red|blue) .*t$")


@query(
    "g08_report_filters",
    """select l_returnflag, l_shipdate, count(*) as n, cast(sum(l_quantity) as bigint) as quantity from lineitem
       where l_linestatus = 'F' group by 1, 2 having sum(l_quantity) > 100""",
)
def g08(t):
    from tidemark.operators import reports as rp

    return rp.report(
        t.lineitem, ["l_returnflag", "l_shipdate"],
        {"n": F.count(F.lit(1)), "quantity": F.sum("l_quantity").cast("bigint")},
        dimension_filter="l_linestatus = 'F'", metric_filter="quantity > 100",
    )
