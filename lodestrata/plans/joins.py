"""Queries of joins and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import objects as O
from ..operators import vault as V
from . import model as M
from .objects import C
from .registry import query, table


@query("j_inner_equi", """select n_name, count(*) as n, cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) as revenue
  from customer join orders on c_custkey = o_custkey join lineitem on o_orderkey = l_orderkey join nation on c_nationkey = n_nationkey group by n_name""")  # fmt: skip
def j_inner_equi(s, d):
    rows = table(s, d, "customer").join(table(s, d, "orders"), F.col("c_custkey") == F.col("o_custkey")).join(table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast(M.D)).cast("decimal(28,2)").alias("revenue"))


@query("j_multi_col", """select a.l_partkey, a.l_suppkey, count(*) as n from lineitem a
  join (select distinct l_partkey, l_suppkey from lineitem where l_returnflag = 'R') b on a.l_partkey = b.l_partkey and a.l_suppkey = b.l_suppkey group by all""")  # fmt: skip
def j_multi_col(s, d):
    lines = M.lineitem(s, d)
    link = O.LinkType("same_supply", lines, lines, (("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey")), "many_to_many")
    return O.follow(link, lines.frame.filter("l_returnflag = 'R'")).groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))


@query("j_link_one_hop", "select * from orders where o_custkey = (select min(c_custkey) from customer) and o_totalprice > 1000 order by o_totalprice desc, o_orderkey limit 20")
def j_link_one_hop(s, d):
    link = M.customer_orders(s, d)
    first = link.source.frame.agg(F.min("c_custkey")).first()[0]
    found = link.target.on(O.follow(link, O.select(link.source, [C("c_custkey", "eq", value=first)])))
    return O.page_frame(found, {"filters": [C("o_totalprice", "gt", value=1000)], "sort": [{"field": "o_totalprice", "order": "desc"}]})


TWO_SQL = "from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F' and o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING'))"


def two(s, d):
    first, second = M.customer_orders(s, d), M.order_lines(s, d)
    return O.two_hops(first, second, O.select(first.source, [C("c_mktsegment", "eq", value="BUILDING")]), [C("o_orderstatus", "eq", value="F")])


query("j_link_two_hop", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity {TWO_SQL}")(lambda s, d: two(s, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
query("j_linked_list", "select o_orderkey, o_custkey, c_name as linked_c_name, c_nationkey as linked_c_nationkey from orders left join customer on o_custkey = c_custkey")(
    lambda s, d: O.with_linked(M.customer_orders(s, d).reverse()).select("o_orderkey", "o_custkey", "linked_c_name", "linked_c_nationkey")
)


@query("j_self_link", "select a.n_nationkey as n_nationkey, b.n_nationkey as linked_n_nationkey from nation a join nation b on a.n_regionkey = b.n_regionkey where a.n_nationkey < b.n_nationkey")
def j_self_link(s, d):
    of = M.nation(s, d)
    link = O.LinkType("same_region", of, M.nation(s, d), (("n_regionkey", "n_regionkey"),), "many_to_many")
    return O.with_linked(link).filter("n_nationkey < linked_n_nationkey").select("n_nationkey", "linked_n_nationkey")


ORPHANS_SQL = "(select o_orderkey, case when o_orderkey % 13 = 0 then -1 else o_custkey end as o_custkey, o_orderstatus from orders)"


def orphans(s, d):
    return table(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, -1).otherwise(F.col("o_custkey")).alias("o_custkey"), "o_orderstatus")


query("j_semi_exists", f"select * from {ORPHANS_SQL} where o_custkey not in (select c_custkey from customer)")(
    lambda s, d: orphans(s, d).join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti")
)


@query("j_cardinality_check", """with a as (select o_orderkey as k, count(*) as n from orders group by 1), b as (select l_orderkey as k, count(*) as m from lineitem group by 1),
  j as (select a.k as ak, b.k as bk, n, m from a full outer join b on a.k = b.k)
  select cast(coalesce(sum(n), 0) as bigint) as source_rows, cast(coalesce(sum(n * m), 0) as bigint) as joined_rows,
    cast(coalesce(sum(case when bk is null then n end), 0) as bigint) as source_orphans, cast(coalesce(sum(case when ak is null then m end), 0) as bigint) as target_orphans,
    cast(coalesce(max(case when bk is not null then n end), 0) as bigint) as max_source_per_key, cast(coalesce(max(m), 0) as bigint) as max_target_per_key,
    coalesce(max(case when bk is not null then n end), 0) <= 1 as fits from j""")  # fmt: skip
def j_cardinality_check(s, d):
    return O.check_link(M.order_lines(s, d))


@query("j_effective_range", f"""with {M.RANGES_SQL}, days as (select distinct cast(ts as date) as day from events)
  select day, user_id, event_type from days join ranges on effective_date <= day and (expiry_date is null or day < expiry_date)""")  # fmt: skip
def j_effective_range(s, d):
    """For many dates: the range that holds each date, emitted from the ranges."""
    days = table(s, d, "events").select(F.to_date("ts").alias("day"))
    states = V.states_by_day({"r": (M.ranges_frame(s, d), "effective_date", ["event_type", "expiry_date"])}, ["user_id"], days)
    return states.filter("r.expiry_date is null or day < r.expiry_date").select("day", "user_id", "r.event_type")


PIT_SQL = """with days as (select distinct cast(ts as date) as day from events), users as (select distinct user_id from events),
  spine as (select user_id, day, cast(day as timestamp) as at from users, days)
  select s.user_id, s.day, arg_max(e.event_id, (e.ts, e.event_id)) as event_id, arg_max(e.event_type, (e.ts, e.event_id)) as event_type
  from spine s join events e on e.user_id = s.user_id and e.ts <= s.at group by s.user_id, s.day"""


def pit(s, d):
    events = table(s, d, "events")
    return V.states_by_day({"e": (events, "ts", ["event_id", "event_type"])}, ["user_id"], events.select(F.to_date("ts").alias("day")), "event_id").select("user_id", "day", "e.event_id", "e.event_type")


query("j_pit", PIT_SQL)(pit)
BRIDGE_SQL = """select sha256(upper(trim(cast(c_custkey as varchar)))) as h_customer, sha256(upper(trim(cast(o_orderkey as varchar)))) as h_order,
  sha256(upper(trim(cast(l_partkey as varchar)))) as h_part, count(*) as n
  from customer join orders on c_custkey = o_custkey join lineitem on o_orderkey = l_orderkey group by all"""


def bridge(s, d):
    c = table(s, d, "customer").select(V.hash_key("c_custkey").alias("h_customer"))
    co = table(s, d, "orders").select(V.hash_key("o_custkey").alias("h_customer"), V.hash_key("o_orderkey").alias("h_order"))
    op = table(s, d, "lineitem").select(V.hash_key("l_orderkey").alias("h_order"), V.hash_key("l_partkey").alias("h_part"))
    return V.bridge([c, co, op], [["h_customer"], ["h_order"]]).groupBy("h_customer", "h_order", "h_part").agg(F.count("*").alias("n"))


query("j_bridge", BRIDGE_SQL)(bridge)
