"""Queries of the change group (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import change as ch
from tidemark.queries import query

ORD = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
OCOLS = "o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate"
LATEST = f"select {OCOLS} from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"
SEQ_SQL = "(datediff('day', timestamp '1970-01-01', o_orderdate) * 1000000000 + o_orderkey)"


def _seq():
    return F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 1_000_000_000 + F.col("o_orderkey")


def snapshots(t):
    """Two versions of a customer list: one segment left, one changed, suppliers joined."""
    v1 = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    kept = v1.filter("c_mktsegment <> 'MACHINERY'").withColumn("c_acctbal", raised)
    added = t.supplier.select(
        (F.col("s_suppkey") + 100_000_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return v1, kept.unionByName(added)


SNAP_SQL = """with v1 as (select c_custkey, c_name, c_acctbal, c_mktsegment from customer),
  v2 as (select c_custkey, c_name, case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end as c_acctbal, c_mktsegment
         from customer where c_mktsegment <> 'MACHINERY'
         union all select s_suppkey + 100000000000, s_name, s_acctbal, 'SUPPLIER' from supplier)"""


@query("c02_apply_scd1", LATEST)
def c02(t):
    return ch.apply_scd1(t.orders.select(*ORD), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "c03_apply_scd1_deletes",
    f"""with f as (select {OCOLS}, false d from orders where o_orderstatus <> 'F'
        union all select o_custkey, o_orderkey, null, null, o_orderdate, true from orders where o_orderstatus = 'F')
        select {OCOLS} from (select * from f qualify row_number() over
          (partition by o_custkey order by o_orderdate desc, o_orderkey desc, d desc) = 1) where not d""",
)
def c03(t):
    o = t.orders.select(*ORD)
    return ch.apply_scd1_deletes(
        o.filter("o_orderstatus <> 'F'"), o.filter("o_orderstatus = 'F'"), ["o_custkey"], ["o_orderdate", "o_orderkey"]
    )


@query(
    "c04_apply_scd2",
    f"""select o_custkey, o_orderstatus, o_totalprice, s as seq, s as __START_AT,
        lead(s) over (partition by o_custkey order by s) as __END_AT
        from (select distinct o_custkey, o_orderstatus, o_totalprice, {SEQ_SQL} s from orders)""",
)
def c04(t):
    feed = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", _seq().alias("seq"))
    # the whole feed arrives twice: exact repeats collapse
    return ch.apply_scd2(feed.unionByName(feed), ["o_custkey"], "seq")


@query(
    "c05_apply_scd2_deletes",
    f"""select o_custkey, o_totalprice, s as seq, s as __START_AT, e as __END_AT from
        (select *, lead(s) over (partition by o_custkey order by s) e from (select o_custkey, o_orderstatus, o_totalprice, {SEQ_SQL} s from orders))
        where o_orderstatus <> 'F'""",
)
def c05(t):
    o = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", _seq().alias("seq"))
    ups = o.filter("o_orderstatus <> 'F'").drop("o_orderstatus")
    return ch.apply_scd2_deletes(ups, o.filter("o_orderstatus = 'F'"), ["o_custkey"], "seq")


@query(
    "c06_apply_snapshot_scd1",
    SNAP_SQL
    + """ select case when v1.c_custkey is null then 'I' when v2.c_custkey is null then 'D' else 'U' end as op, count(*) as rows
      from v1 full join v2 on v1.c_custkey = v2.c_custkey
      where v1.c_custkey is null or v2.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal group by 1""",
)
def c06(t):
    v1, v2 = snapshots(t)
    return ch.apply_snapshot_scd1(v1, v2, ["c_custkey"])[1]


@query(
    "c07_apply_snapshot_scd2",
    SNAP_SQL
    + """ select v1.*, 1 as __START_AT, case when v2.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal then 2 end as __END_AT
      from v1 left join v2 on v1.c_custkey = v2.c_custkey
      union all select v2.*, 2, case when v1.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal then 3 end
      from v2 left join v1 on v1.c_custkey = v2.c_custkey where v1.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal
      union all select v1.*, 3, null from v1 left join v2 on v1.c_custkey = v2.c_custkey
      where v2.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal""",
)
def c07(t):
    v1, v2 = snapshots(t)
    h = ch.open_history(v1, F.lit(1))
    h = ch.apply_snapshot_scd2(h, v2, ["c_custkey"], F.lit(2))
    return ch.apply_snapshot_scd2(h, v1, ["c_custkey"], F.lit(3))


C08_SQL = (
    SNAP_SQL
    + """ select coalesce(v2.c_custkey, v1.c_custkey) c_custkey, coalesce(v2.c_name, v1.c_name) c_name,
      coalesce(v2.c_acctbal, v1.c_acctbal) c_acctbal, coalesce(v2.c_mktsegment, v1.c_mktsegment) c_mktsegment,
      case when v1.c_custkey is null then 'I' when v2.c_custkey is null then 'D' else 'U' end as op
      from v1 full join v2 on v1.c_custkey = v2.c_custkey
      where v1.c_custkey is null or v2.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal"""
)


@query("c08_snapshot_diff", C08_SQL)
def c08(t):
    v1, v2 = snapshots(t)
    return ch.snapshot_diff(v1, v2, ["c_custkey"])


@query("c08_diff_by_digest", C08_SQL)
def c08_by_digest(t):
    v1, v2 = snapshots(t)
    return ch.snapshot_diff_by_digest(v1, v2, ["c_custkey"])


def _flagged(t):
    return t.orders.select(
        "o_custkey", "o_orderkey", "o_totalprice", _seq().alias("seq"), (F.col("o_orderstatus") == "F").alias("_deleted")
    )


@query(
    "c09_inband_soft",
    f"""select o_custkey, o_orderkey, o_totalprice, {SEQ_SQL} as seq, o_orderstatus = 'F' as _deleted from orders
        qualify row_number() over (partition by o_custkey order by {SEQ_SQL} desc) = 1""",
)
def c09(t):
    return ch.apply_inband_tombstones(_flagged(t), ["o_custkey"], "seq", mode="soft")


@query(
    "c09_inband_hard",
    f"""select o_custkey, o_orderkey, o_totalprice, seq from (select *, {SEQ_SQL} as seq from orders
        qualify row_number() over (partition by o_custkey order by {SEQ_SQL} desc) = 1) where o_orderstatus <> 'F'""",
)
def c09_hard(t):
    return ch.apply_inband_tombstones(_flagged(t), ["o_custkey"], "seq", mode="hard")


@query("c10_out_of_order", LATEST)
def c10(t):
    o = t.orders.select(*ORD)
    # every change is delivered twice, the old ones after the new ones
    first, second = o.filter("o_orderstatus = 'O'"), o.filter("o_orderstatus <> 'O'")
    return ch.apply_scd1(first.unionByName(second).unionByName(first).unionByName(o), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "c11_rev_relist",
    """select o_custkey, rev, o_totalprice from (select o_custkey, cast(o_orderkey as int) rev, o_totalprice from orders)
       qualify row_number() over (partition by o_custkey order by rev desc) = 1""",
)
def c11(t):
    feed = t.orders.select("o_custkey", F.col("o_orderkey").cast("int").alias("rev"), "o_totalprice")
    target = ch.apply_scd1(feed, ["o_custkey"], "rev")
    # the full list comes again: equal revisions change nothing
    return ch.apply_scd1(target.unionByName(feed), ["o_custkey"], "rev")


@query("c12_clustered", "select l_orderkey, l_linenumber, l_shipdate, l_returnflag, l_quantity from lineitem")
def c12(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_quantity")
    return ch.clustered(df, ["l_returnflag", "l_shipdate"])


@query("c13_full_row_dedupe", "select distinct l_returnflag, l_linestatus, l_quantity, l_discount, l_shipdate from lineitem")
def c13(t):
    return ch.full_row_dedupe(t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_shipdate"))
