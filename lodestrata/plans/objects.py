"""Queries of filters, search, pages, dates, interfaces and the record graph."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import objects as O
from ..shared import keep
from . import model as M
from .registry import query, table

C = lambda f, op, **v: {"field": f, "op": op, **v}

query("q_select", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 2 as double_quantity, upper(l_returnflag) as flag from lineitem")(
    lambda s, d: table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity * 2 as double_quantity", "upper(l_returnflag) as flag")
)


@query("q_with", "with big as (select * from orders where o_totalprice > 300000) select o_orderstatus, count(*) as n from big group by o_orderstatus")
def q_with(s, d):
    table(s, d, "orders").createOrReplaceTempView("q_with_orders")
    return s.sql("with big as (select * from q_with_orders where o_totalprice > 300000) select o_orderstatus, count(*) as n from big group by o_orderstatus")


query("q_where", "select * from orders where o_orderdate >= timestamp '1997-01-01 00:00:00' and o_orderstatus = 'F' and o_totalprice < 100000")(
    lambda s, d: table(s, d, "orders").filter("o_orderdate >= timestamp_ntz'1997-01-01 00:00:00' and o_orderstatus = 'F' and o_totalprice < 100000")
)
query("q_case", "select o_orderkey, case when o_totalprice >= 300000 then 'high' when o_totalprice >= 100000 then 'middle' else 'low' end as band from orders")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", F.when(F.col("o_totalprice") >= 300000, "high").when(F.col("o_totalprice") >= 100000, "middle").otherwise("low").alias("band"))
)


def filtered(name: str, make, filters: list[dict], sql: str):
    query(name, sql)(lambda s, d: O.select(make(s, d), filters))


filtered("f_eq", M.customer, [C("c_mktsegment", "eq", value="BUILDING")], "select * from customer where c_mktsegment = 'BUILDING'")
filtered("f_neq", M.customer, [C("c_mktsegment", "neq", value="BUILDING")], "select * from customer where c_mktsegment <> 'BUILDING'")
filtered("f_range", M.orders, [C("o_totalprice", "gt", value="1000.50"), C("o_totalprice", "lte", value=200000), C("o_orderdate", "gte", value="1996-01-01"), C("o_orderdate", "lt", value="1998-01-01")],
         "select * from orders where o_totalprice > 1000.50 and o_totalprice <= 200000 and o_orderdate >= '1996-01-01' and o_orderdate < '1998-01-01'")
filtered("f_in", M.orders, [C("o_orderpriority", "in", values=["1-URGENT", "2-HIGH"])], "select * from orders where o_orderpriority in ('1-URGENT', '2-HIGH')")
filtered("f_contains", M.part, [C("p_name", "contains", value="RED ge")], "select * from part where lower(p_name) like '%red%' and lower(p_name) like '%ge%'")
filtered("f_flat_and", M.customer, [C("c_mktsegment", "eq", value="BUILDING"), C("c_nationkey", "lt", value=10)], "select * from customer where c_mktsegment = 'BUILDING' and c_nationkey < 10")
query("f_between", "select * from part where p_size between 10 and 20")(lambda s, d: O.select(M.part(s, d), where={"clause": C("p_size", "between", values=[10, 20])}))

NULLS_SQL = """(select o_orderkey, o_custkey, case when o_orderkey % 7 = 0 then null else o_orderpriority end as priority,
  case when o_orderkey % 11 = 0 then null else o_totalprice end as price from orders)"""


def with_nulls(s, d) -> O.ObjectType:
    rows = table(s, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("price"))
    return O.ObjectType("Gappy", rows, ("o_orderkey",), {"o_orderkey": O.Property("bigint"), "o_custkey": O.Property("bigint"), "priority": O.Property("string"), "price": O.Property("double")})


query("f_null", f"select * from {NULLS_SQL} where priority is null and price is not null")(lambda s, d: O.select(with_nulls(s, d), [C("priority", "is_null"), C("price", "not_null")]))
TREE = {"group": "or", "items": [{"group": "and", "items": [{"clause": C("c_mktsegment", "eq", value="BUILDING")}, {"clause": C("c_acctbal", "gt", value=0)}]}, {"clause": C("c_nationkey", "in", values=[1, 2, 3]), "negated": False}, {"group": "and", "negated": True, "items": [{"clause": C("c_nationkey", "gte", value=5)}]}]}
query("f_tree", "select * from customer where (c_mktsegment = 'BUILDING' and c_acctbal > 0) or c_nationkey in (1, 2, 3) or not (c_nationkey >= 5)")(lambda s, d: O.select(M.customer(s, d), where=TREE))


@query("f_capability", "select * from customer where c_name = 'Customer#000000001'")
def f_capability(s, d):
    """Only properties that are filterable may be filtered; the refusals are in the tests."""
    return O.select(M.customer(s, d), [C("c_name", "eq", value="Customer#000000001")])


@query("f_source_linked", "select o_orderkey, o_custkey, c_mktsegment as linked_c_mktsegment from orders join customer on o_custkey = c_custkey where o_totalprice > 200000 and c_mktsegment = 'BUILDING'")
def f_source_linked(s, d):
    link = M.customer_orders(s, d).reverse()
    rows = O.with_linked(link).filter(O.all_of(link.source, [C("o_totalprice", "gt", value=200000), C("c_mktsegment", "eq", value="BUILDING", source="linked")], link.target))
    return rows.select("o_orderkey", "o_custkey", "linked_c_mktsegment")


query("f_require_filter", "select * from lineitem where l_orderkey = 7")(lambda s, d: O.select(M.lineitem(s, d), [C("l_orderkey", "eq", value=7)]))
query("f_prefix_search", "select * from customer where starts_with(lower(c_name), 'customer#00000001')")(lambda s, d: O.search(M.customer(s, d), "CUSTOMER#00000001"))


@query("f_ignore_hidden", "select c_custkey, c_name, c_nationkey, c_mktsegment from customer where c_acctbal > 5000")
def f_ignore_hidden(s, d):
    of = M.customer(s, d)
    return O.select(of, [C("c_acctbal", "gt", value=5000)]).select(*of.shown())


# Sort and pages

query("s_order", "select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderstatus desc, o_totalprice, o_orderkey limit 50")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").orderBy(F.desc("o_orderstatus"), "o_totalprice", "o_orderkey").limit(50)
)


@query("s_pk_tiebreak", "select o_orderkey, o_orderpriority from orders order by o_orderpriority, o_orderkey limit 30")
def s_pk_tiebreak(s, d):
    of = M.orders(s, d)
    return O.ordered(of.frame, O.sort_keys(of, [{"field": "o_orderpriority"}])).select("o_orderkey", "o_orderpriority").limit(30)


query("s_limit", "select o_orderkey from orders order by o_orderkey limit 100")(lambda s, d: table(s, d, "orders").select("o_orderkey").orderBy("o_orderkey").limit(100))
query("s_offset", "select o_orderkey, o_custkey from orders order by o_orderkey limit 200 offset 100")(lambda s, d: O.by_offset(table(s, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey"), 100, 200))

SORT = {"sort": [{"field": "priority", "order": "desc"}, {"field": "price"}], "page_size": 25, "filters": [C("o_custkey", "gte", value=3)]}
PAGE_ORDER = "order by priority desc nulls last, price asc nulls first, o_orderkey"
query("p_keyset_first", f"select * from {NULLS_SQL} where o_custkey >= 3 {PAGE_ORDER} limit 25")(lambda s, d: O.page_frame(with_nulls(s, d), SORT))


@query("p_keyset_next", f"select * from {NULLS_SQL} where o_custkey >= 3 {PAGE_ORDER} limit 25 offset 25")
def p_keyset_next(s, d):
    of = with_nulls(s, d)
    return O.page_frame(of, SORT | {"direction": "next", "cursor": O.page(of, SORT).next})


@query("p_keyset_prev", f"select * from {NULLS_SQL} where o_custkey >= 3 {PAGE_ORDER} limit 25")
def p_keyset_prev(s, d):
    of = with_nulls(s, d)
    second = O.page(of, SORT | {"direction": "next", "cursor": O.page(of, SORT).next})
    return O.page_frame(of, SORT | {"direction": "previous", "cursor": second.previous})


@query("p_cursor_guard")
def p_cursor_guard(s, d):
    """The second page by a cursor that is read back; a cursor of another filter is refused."""
    of, other = with_nulls(s, d), SORT | {"filters": []}
    cursor = O.page(of, SORT).next
    try:
        O.read_cursor(other, cursor)
    except ValueError:
        return O.page_frame(of, SORT | {"direction": "next", "cursor": cursor})
    raise AssertionError("a cursor of another request was taken")


@query("p_get_by_pk", "select * from lineitem where (l_orderkey, l_linenumber, l_partkey, l_suppkey) = (select min((l_orderkey, l_linenumber, l_partkey, l_suppkey)) from lineitem)")
def p_get_by_pk(s, d):
    of = M.lineitem(s, d)
    first = of.frame.agg(F.min(F.struct(*of.key)).alias("k")).first()["k"]
    return O.get(of, O.encode_key(list(first)))


# Dates

query("d_none", "select * from customer")(lambda s, d: O.at_date(M.customer(s, d)))
query("d_snapshot", f"with {M.BALANCE_SQL} select * from balance where snap_date = (select max(snap_date) from balance)")(lambda s, d: O.at_date(M.balance(s, d)))
query("d_effective", f"with {M.RANGES_SQL} select * from ranges where effective_date <= timestamp '2024-01-15' and (expiry_date is null or expiry_date > timestamp '2024-01-15')")(
    lambda s, d: O.at_date(M.status_range(s, d), "2024-01-15 00:00:00").select("user_id", "event_type", "effective_date", "expiry_date")
)


@query("d_latest_date", "select o_custkey, cast(max(o_orderdate) as date) as latest_date from orders group by o_custkey")
def d_latest_date(s, d):
    of = M.balance(s, d)
    return O.latest_dates(O.ObjectType(of.name, of.frame, ("o_custkey",), of.properties, of.date))


# Interfaces and sets

SHARED = {"key": ("bigint", {"Customer": "c_custkey", "Supplier": "s_suppkey"}), "name": ("string", {"Customer": "c_name", "Supplier": "s_name"}), "nation": ("int", {"Customer": "c_nationkey", "Supplier": "s_nationkey"})}
BOTH = """(select 'Customer' as __type, c_custkey as key, c_name as name, c_nationkey as nation from customer
  union all select 'Supplier', s_suppkey, s_name, s_nationkey from supplier)"""
query("u_interface", f"select * from {BOTH} where nation = 3")(lambda s, d: O.interface([M.customer(s, d), M.supplier(s, d)], SHARED, [C("nation", "eq", value=3)]))
query("u_shared_property", f"select * from {BOTH}")(lambda s, d: O.interface([M.customer(s, d), M.supplier(s, d)], SHARED))
query("u_object_set", "select * from customer where c_mktsegment = 'BUILDING' order by c_acctbal desc, c_custkey limit 40")(
    lambda s, d: O.run_set(M.customer(s, d), json.dumps({"filters": [C("c_mktsegment", "eq", value="BUILDING")], "sort": [{"field": "c_acctbal", "order": "desc"}], "page_size": 40}))
)


# Record graph


def graph_edges(s, d):
    o = table(s, d, "orders").select(F.concat(F.lit("customer:"), F.col("o_custkey")).alias("a"), F.concat(F.lit("order:"), F.col("o_orderkey")).alias("b"))
    p = table(s, d, "lineitem").select(F.concat(F.lit("order:"), F.col("l_orderkey")).alias("a"), F.concat(F.lit("part:"), F.col("l_partkey")).alias("b"))
    both = o.union(p)
    return both.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(both.select(F.col("b").alias("src"), F.col("a").alias("dst")))


GRAPH_SQL = """
with recursive e0 as (select 'customer:' || o_custkey as a, 'order:' || o_orderkey as b from orders
  union all select 'order:' || l_orderkey, 'part:' || l_partkey from lineitem),
e1 as (select a as src, b as dst from e0 union select b, a from e0),
e as (select src, dst from (select src, dst, row_number() over (partition by src order by dst) as r from e1) where r <= 8),
walk as (select 'customer:' || min(o_custkey) as node, 0 as step from orders
  union select e.dst, w.step + 1 from walk w join e on e.src = w.node where w.step < 3)
select node, min(step) as step from walk group by node"""


@query("g_expand", GRAPH_SQL)
def g_expand(s, d):
    start = table(s, d, "orders").agg(F.concat(F.lit("customer:"), F.min("o_custkey")).alias("node"))
    return O.expand(start, graph_edges(s, d), 3, keep)


@query("g_resolve_snapshot", f"""with {M.BALANCE_SQL}, b as (select * from balance where snap_date = (select max(snap_date) from balance))
  select c.c_custkey, c.c_nationkey, b.snap_date, b.balance from b join customer c on c.c_custkey = b.o_custkey""")  # fmt: skip
def g_resolve_snapshot(s, d):
    """Each type's date policy is applied before the link is followed."""
    of = M.balance(s, d)
    return O.at_date(of).join(O.at_date(M.customer(s, d)), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_nationkey", "snap_date", "balance")


