"""Queries of warehouse modelling and materialised copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import copies as K
from ..operators import vault as V
from ..shared import keep, new_path
from . import model as M
from .joins import BRIDGE_SQL, PIT_SQL, bridge, pit
from .objects import NULLS_SQL, with_nulls
from .registry import query, table
from .tables import B, MERGED, T, base_orders, delta, orders_log


def h(*columns: str) -> str:
    return "sha256(" + " || '||' || ".join(f"coalesce(upper(trim(cast({c} as varchar))), '^^')" for c in columns) + ")"


def raw(*columns: str) -> str:
    return "sha256(" + " || '||' || ".join(f"coalesce(cast({c} as varchar), '^^')" for c in columns) + ")"


def loaded():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


query("dv_hash_key", f"select o_orderkey, {h('o_custkey', 'priority')} as hk from {NULLS_SQL}")(lambda s, d: with_nulls(s, d).frame.select("o_orderkey", V.hash_key("o_custkey", "priority").alias("hk")))
query("dv_hash_diff", f"select c_custkey, {raw('c_mktsegment', 'c_name', 'c_nationkey')} as hash_diff from customer")(lambda s, d: table(s, d, "customer").select("c_custkey", V.hash_diff("c_name", "c_nationkey", "c_mktsegment").alias("hash_diff")))
query("dv_link_key", f"select o_orderkey, sha256(upper({h('o_custkey')}) || '||' || upper({h('o_orderkey')})) as hk from orders")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", V.hash_key(V.hash_key("o_custkey"), V.hash_key("o_orderkey")).alias("hk"))
)


@query("dv_hub", f"select {h('c_custkey')} as hkey_hub, c_custkey from customer where c_custkey % 2 = 1")
def dv_hub(s, d):
    """Only keys that aren't stored yet."""
    rows = table(s, d, "customer").select("c_custkey")
    return V.hub(V.hub(None, rows.filter("c_custkey % 2 = 0"), "hkey_hub", ["c_custkey"]), rows.union(rows), "hkey_hub", ["c_custkey"])


@query("dv_link", f"select distinct sha256(upper({h('o_custkey')}) || '||' || upper({h('o_orderkey')})) as hkey_link, {h('o_custkey')} as hkey_customer, {h('o_orderkey')} as hkey_order from orders")
def dv_link(s, d):
    return V.link(None, table(s, d, "orders"), "hkey_link", {"hkey_customer": ["o_custkey"], "hkey_order": ["o_orderkey"]})


SAT_SQL = """select user_id, {hash} as hash_diff, event_type, ts, event_id from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as prev from events)
  where prev is null or prev <> event_type"""


def event_history(s, d):
    """The users' event types after two loads, the second with as many late rows as new ones."""
    rows, history = table(s, d, "events").select("user_id", "event_type", "ts", "event_id"), None
    for half in (1, 0):
        changes = keep(V.splice(history, rows.filter(F.col("event_id") % 2 == half), "user_id", ["event_type"], "ts", "event_id"), "changes")
        history = V.spliced(history, changes, "user_id", "ts", "event_id")
    return history


# Two loads give what one load of all rows would.
query("dv_sat", SAT_SQL.format(hash=raw("event_type")))(lambda s, d: event_history(s, d).filter("changed").drop("changed"))


@query("dv_lsat", f"""with r as (select {h('l_orderkey', 'l_partkey', 'l_suppkey')} as hkey_link, l_returnflag, l_linestatus, l_shipdate, l_linenumber from lineitem),
  m as (select *, {raw('l_linestatus', 'l_returnflag')} as hash_diff, lag({raw('l_linestatus', 'l_returnflag')}) over (partition by hkey_link order by l_shipdate, l_linenumber) as prev from r)
  select hkey_link, hash_diff, l_returnflag, l_linestatus, l_shipdate, l_linenumber from m where prev is null or prev <> hash_diff""")  # fmt: skip
def dv_lsat(s, d):
    rows = table(s, d, "lineitem").withColumn("hkey_link", V.hash_key("l_orderkey", "l_partkey", "l_suppkey"))
    return V.satellite(None, rows, "hkey_link", ["l_returnflag", "l_linestatus"], "l_shipdate", "l_linenumber")


RANGES = f"with {M.RANGES_SQL} select *, expiry_date is null as is_current from ranges"
query("dv_lsate", RANGES)(lambda s, d: V.ranges(keep(event_history(s, d).filter("changed"), "points"), ["user_id"], ["event_type"], "ts", "event_id"))
query("scd2", RANGES)(M.ranges_frame)
LAST = "select event_id, ts, user_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"


def short_events(s, d):
    return table(s, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


query("dv_current", LAST)(lambda s, d: V.current(short_events(s, d), ["user_id"], "ts", "event_id"))
query("dv_seq_order", LAST.replace("order by ts desc,", "order by cast(ts as date) desc,"))(
    lambda s, d: V.current(short_events(s, d).withColumn("day", F.to_date("ts")), ["user_id"], "day", "event_id").drop("day")
)
query("dv_snapshot", PIT_SQL)(pit)


@query("dv_pit", """with days as (select distinct cast(ts as date) as day from events), spine as (select distinct e.user_id, days.day from events e, days),
  a as (select s.user_id, s.day, max((e.ts, e.event_id)) as m from spine s join events e on e.user_id = s.user_id and e.ts <= s.day and e.event_type = 'view' group by all),
  b as (select s.user_id, s.day, max((e.ts, e.event_id)) as m from spine s join events e on e.user_id = s.user_id and e.ts <= s.day and e.event_type <> 'view' group by all)
  select user_id, day, a.m[2] as view_id, b.m[2] as other_id from spine left join a using (user_id, day) left join b using (user_id, day) where a.m is not null or b.m is not null""")  # fmt: skip
def dv_pit(s, d):
    """For each key and day the rows in effect of two satellites."""
    events = table(s, d, "events")
    two = {"a": (events.filter("event_type = 'view'"), "ts", ["event_id"]), "b": (events.filter("event_type <> 'view'"), "ts", ["event_id"])}
    states = V.states_by_day(two, ["user_id"], events.select(F.to_date("ts").alias("day")), "event_id")
    return states.select("user_id", "day", F.col("a.event_id").alias("view_id"), F.col("b.event_id").alias("other_id"))


query("dv_bridge", BRIDGE_SQL)(bridge)


@query("dv_sat_biz", """with t as (select c_custkey, cast(coalesce(sum(cast(o_totalprice as decimal(18,2))), 0) as decimal(28,2)) as spend from customer left join orders on o_custkey = c_custkey group by 1)
  select c_custkey, spend, cast(rank() over (order by spend desc) as bigint) as spend_rank from t""")  # fmt: skip
def dv_sat_biz(s, d):
    """Customers ranked by spend: ranks are counted from the distinct amounts, so that rows aren't sorted in one task."""
    spend = table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(F.col("o_totalprice").cast(M.D)).alias("spend"))
    rows = table(s, d, "customer").select("c_custkey").join(spend, "c_custkey", "left").select("c_custkey", F.coalesce("spend", F.lit(0)).cast("decimal(28,2)").alias("spend"))
    return K.ranked(rows, "spend", "spend_rank")


@query("dv_audit", """select event_id, ts, timestamp '2024-06-01' as dv_ldt, ts as dv_src_ldt, 'app.events' as dv_src_rec,
  case when event_type = 'signup' then 'INSERT' else 'UPDATE' end as dv_cdc_ops, date '2024-06-01' as dv_ccd from events""")  # fmt: skip
def dv_audit(s, d):
    op = F.when(F.col("event_type") == "signup", "INSERT").otherwise("UPDATE")
    return V.audited(table(s, d, "events"), "app.events", "ts", loaded(), op).select("event_id", "ts", "dv_ldt", "dv_src_ldt", "dv_src_rec", "dv_cdc_ops", "dv_ccd")


@query("scd1", f"select * from {MERGED}")
def scd1(s, d):
    log = orders_log(s, d)
    log.merge(delta(s, d), "2024-01-02 00:00:00")
    return log.read()


query("star_dim", f"select {h('c_custkey')} as dim_customer_key, c_custkey, c_name, c_mktsegment from customer union all select repeat('0', 64), null, null, null")(
    lambda s, d: V.dimension(table(s, d, "customer"), "dim_customer_key", ["c_custkey"], ["c_name", "c_mktsegment"])
)


@query("star_fact", f"select o_orderkey, case when o_orderkey % 13 = 0 then repeat('0', 64) else {h('o_custkey')} end as dim_customer_key from orders")
def star_fact(s, d):
    rows = table(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, -1).otherwise(F.col("o_custkey")).alias("o_custkey"))
    dim = V.dimension(table(s, d, "customer"), "dim_customer_key", ["c_custkey"], ["c_name"])
    return V.fact(rows, {"dim_customer_key": (dim, ["c_custkey"], ["o_custkey"])}).select("o_orderkey", "dim_customer_key")


query("star_agg", "select cast(o_orderdate as date) as day, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as value from orders group by 1")(
    lambda s, d: table(s, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast(M.D)).cast("decimal(28,2)").alias("value"))
)


@query("star_wide", """with o as (select o_custkey as c_custkey, count(*) as n_orders from orders group by 1), l as (select o_custkey as c_custkey, count(*) as n_lines from orders join lineitem on l_orderkey = o_orderkey group by 1)
  select c_custkey, c_name, coalesce(n_orders, 0) as n_orders, coalesce(n_lines, 0) as n_lines from customer left join o using (c_custkey) left join l using (c_custkey)""")  # fmt: skip
def star_wide(s, d):
    """Several facts on one customer, each aggregated to the customer first."""
    o = table(s, d, "orders")
    per_order = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    n_orders = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    n_lines = o.join(per_order, "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("n").alias("n_lines"))
    out = table(s, d, "customer").select("c_custkey", "c_name").join(n_orders, "c_custkey", "left").join(n_lines, "c_custkey", "left")
    return out.na.fill(0, ["n_orders", "n_lines"])


query("ml_bronze", "select *, timestamp '2024-06-01' as dv_ldt, ts as dv_src_ldt, 'app.events' as dv_src_rec, 'INIT' as dv_cdc_ops, date '2024-06-01' as dv_ccd from events")(
    lambda s, d: V.audited(table(s, d, "events"), "app.events", "ts", loaded(), F.lit("INIT"))
)


@query("ml_silver", "select event_id, ts, upper(event_type) as event_type, cast(value as decimal(18,2)) as amount, cast(json_extract_string(props, '$.k') as integer) as k from events where event_id % 2 = 0 union all select event_id, ts, upper(event_type), cast(value as decimal(18,2)), cast(json_extract_string(props, '$.k') as integer) from events where event_id % 2 = 1")
def ml_silver(s, d):
    """Two sources in standard types, without repeated keys."""
    rows = table(s, d, "events")
    parts = [rows.filter(f"event_id % 2 = {i}") for i in (0, 1)]
    typed = [p.union(p).select("event_id", "ts", F.upper("event_type").alias("event_type"), F.col("value").cast(M.D).alias("amount"), F.get_json_object("props", "$.k").cast("int").alias("k")) for p in parts]
    return V.current(typed[0].unionByName(typed[1]), ["event_id"], "ts", "event_id")


@query("ml_gold", "select c_mktsegment, count(*) as n_orders from orders join customer on o_custkey = c_custkey group by all")
def ml_gold(s, d):
    dim = V.dimension(table(s, d, "customer"), "dim_customer_key", ["c_custkey"], ["c_mktsegment"])
    V.fact(table(s, d, "orders"), {"dim_customer_key": (dim, ["c_custkey"], ["o_custkey"])}).createOrReplaceTempView("gold_fct_order")
    dim.createOrReplaceTempView("gold_dim_customer")
    return s.sql("select c_mktsegment, count(*) as n_orders from gold_fct_order join gold_dim_customer using (dim_customer_key) group by c_mktsegment")


@query("dv_incremental_model", f"select * from {B}")
def dv_incremental_model(s, d):
    """A first build of the old orders, then a run that merges the new and changed ones."""
    rows = base_orders(s, d)
    log = T.ChangeLog.create(rows.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("?")), ["o_orderkey"], "2024-01-01 00:00:00")
    log.merge(rows, "2024-01-02 00:00:00")
    return log.read()


# Views and copies


@query("v_create", "select c_custkey, c_name, n_name from customer join nation on c_nationkey = n_nationkey")
def v_create(s, d):
    table(s, d, "customer").createOrReplaceTempView("v_customer")
    table(s, d, "nation").createOrReplaceTempView("v_nation")
    s.sql("create or replace temporary view v_customer_nation as select c_custkey, c_name, n_name from v_customer join v_nation on c_nationkey = n_nationkey")
    return s.table("v_customer_nation")


@query("v_drop", "select count(*) as n, false as there from customer")
def v_drop(s, d):
    """Dropping a view leaves its data."""
    table(s, d, "customer").createOrReplaceTempView("v_dropped")
    s.sql("drop view v_dropped")
    return table(s, d, "customer").agg(F.count("*").alias("n"), F.lit(s.catalog.tableExists("v_dropped")).alias("there"))


SPEC = {"dimensions": ["l_returnflag"], "measures": [("sum", "l_quantity"), ("count", None), ("avg", "l_quantity"), ("max", "l_extendedprice")]}
COPY = {"dimensions": ["l_returnflag", "l_linestatus", "l_suppkey"], "columns": ["l_quantity", "l_extendedprice"]}
ANSWER = """select l_returnflag, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as sum_l_quantity, count(*) as count, cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(*) as avg_l_quantity,
  max(cast(l_extendedprice as decimal(18,2))) as max_l_extendedprice from lineitem {} group by all"""


def lines(s, d):
    return table(s, d, "lineitem").withColumns({c: F.col(c).cast(M.D) for c in ("l_quantity", "l_extendedprice")})


def shaped(rows):
    return rows.withColumn("sum_l_quantity", F.col("sum_l_quantity").cast("decimal(28,2)"))


@query("r_raw", "select l_orderkey, l_quantity, l_returnflag from lineitem")
def r_raw(s, d):
    return K.RawCopy.build(table(s, d, "lineitem"), new_path(s, "raw"), ["l_orderkey", "l_quantity", "l_returnflag"], ["l_returnflag"], ["l_orderkey"]).read()


@query("r_agg", "select l_returnflag, l_linestatus, l_suppkey, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as sum_l_quantity from lineitem group by 1, 2, 3")
def r_agg(s, d):
    copy = K.AggregateCopy.build(lines(s, d), new_path(s, "agg"), COPY["dimensions"], COPY["columns"], version=1)
    return copy.read().select("l_returnflag", "l_linestatus", "l_suppkey", "n", F.col("sum_l_quantity").cast("decimal(28,2)").alias("sum_l_quantity"))


@query("r_answer", ANSWER.format(""))
def r_answer(s, d):
    """The copy covers the query, so it answers; the result is the base table's."""
    copy = K.AggregateCopy.build(lines(s, d), new_path(s, "agg"), COPY["dimensions"], COPY["columns"], version=1)
    rows, used = K.answer(lines(s, d), SPEC, [copy])
    assert used is copy
    return shaped(rows)


@query("r_refresh", ANSWER.format(""))
def r_refresh(s, d):
    """New rows are aggregated and their states merged with the stored ones."""
    rows = lines(s, d)
    copy = K.AggregateCopy.build(rows.filter("l_orderkey % 2 = 0"), new_path(s, "agg"), COPY["dimensions"], COPY["columns"], version=1)
    copy.refresh(rows.filter("l_orderkey % 2 = 1"), version=2)
    return shaped(K.answer(rows, SPEC, [copy])[0])


def statuses(s, d):
    copy = K.AggregateCopy.build(lines(s, d), new_path(s, "agg"), COPY["dimensions"], COPY["columns"], version=1)
    return K.status(s, [("by_supplier", copy, "2024-01-01 00:00:00", 2), ("again", copy, "2024-01-09 00:00:00", 1)])


query("r_staleness", "select 'by_supplier' as name, 1 as version, 2 as source_version, true as is_stale, (select count(*) from (select distinct l_returnflag, l_linestatus, l_suppkey from lineitem)) as n_rows union all select 'again', 1, 1, false, (select count(*) from (select distinct l_returnflag, l_linestatus, l_suppkey from lineitem))")(
    lambda s, d: statuses(s, d).select("name", "version", "source_version", "is_stale", "n_rows")
)
query("r_expire", "select 'again' as name, (select count(*) from (select distinct l_returnflag, l_linestatus, l_suppkey from lineitem)) as n_rows")(lambda s, d: K.fresh(statuses(s, d), "2024-01-10 00:00:00", 72).select("name", "n_rows"))
