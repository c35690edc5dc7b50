"""Queries of aggregates, windows and charts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metrics as X
from ..operators import objects as O
from . import model as M
from .joins import TWO_SQL, two
from .objects import C
from .registry import query, table

SUM = "cast(sum({}) as decimal(28,2))"


def total(c: str):
    return F.sum(F.col(c).cast(M.D)).cast("decimal(28,2)")


@query("a_group_by", """select c_custkey, c_name, count(*) as n_lines, cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(28,2)) as amount
  from customer join orders on c_custkey = o_custkey join lineitem on o_orderkey = l_orderkey group by c_custkey, c_name""")  # fmt: skip
def a_group_by(s, d):
    rows = table(s, d, "customer").join(table(s, d, "orders"), F.col("c_custkey") == F.col("o_custkey")).join(table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy("c_custkey", "c_name").agg(F.count("*").alias("n_lines"), total("l_extendedprice").alias("amount"))


def agg(name, make, groups, measures, sql, **more):
    query(name, sql)(lambda s, d: O.aggregate((of := make(s, d)), of.frame, groups, measures, more.get("max_buckets")))


P = lambda p, **v: {"property": p, **v}
agg("a_count", M.customer, [P("c_mktsegment")], [{"op": "count"}], "select c_mktsegment, count(*) as count from customer group by all")
agg("a_min_max", M.orders, [P("o_orderstatus")], [P("o_totalprice", op="min"), P("o_totalprice", op="max")], "select o_orderstatus, min(cast(o_totalprice as decimal(18,2))) as min_o_totalprice, max(cast(o_totalprice as decimal(18,2))) as max_o_totalprice from orders group by all")
agg("a_cardinality", M.orders, [P("o_orderpriority")], [P("o_custkey", op="cardinality")], "select o_orderpriority, count(distinct o_custkey) as cardinality_o_custkey from orders group by all")
agg("a_avg", M.orders, [P("o_orderstatus")], [P("o_totalprice", op="avg")], "select o_orderstatus, cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as avg_o_totalprice from orders group by all")
agg("a_bucket_exact", M.customer, [P("c_nationkey", bucket="exact")], [{"op": "count"}], "select c_nationkey, count(*) as count from customer group by all")


@query("a_sum", "select o_orderpriority, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as sum_o_totalprice from orders group by all")
def a_sum(s, d):
    of = M.orders(s, d)
    return O.aggregate(of, of.frame, [P("o_orderpriority")], [P("o_totalprice", op="sum")], None).withColumn("sum_o_totalprice", F.col("sum_o_totalprice").cast("decimal(28,2)"))


@query("a_conditional", "select o_orderpriority, count(*) filter (o_orderstatus = 'F') as n_f, cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) end) as decimal(28,2)) as value_f from orders group by all")
def a_conditional(s, d):
    of, closed = M.orders(s, d), [C("o_orderstatus", "eq", value="F")]
    m = X.Metrics(of, {"n_f": {"kind": "simple", "op": "count", "filters": closed}, "value_f": {"kind": "simple", "op": "sum", "property": "o_totalprice", "filters": closed}})
    return m.query(["n_f", "value_f"], ["o_orderpriority"]).withColumn("value_f", F.col("value_f").cast("decimal(28,2)"))


UNITS = " union all ".join(f"select '{u}' as unit, cast(date_trunc('{u}', o_orderdate) as date) as o_orderdate, count(*) as count from orders group by all" for u in ("day", "week", "month", "quarter", "year"))


@query("a_bucket_time", UNITS)
def a_bucket_time(s, d):
    of = M.orders(s, d)
    parts = [O.aggregate(of, of.frame, [P("o_orderdate", bucket=b)], [{"op": "count"}], None).select(F.lit(u).alias("unit"), "o_orderdate", "count") for b, u in O.UNITS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


agg("a_bucket_ranges", M.orders, [P("o_totalprice", bucket="by_ranges", ranges=[[None, 50000], [50000, 200000], [200000, None]])], [{"op": "count"}],
    "select case when o_totalprice < 50000 then '..50000' when o_totalprice < 200000 then '50000..200000' else '200000..' end as o_totalprice, count(*) as count from orders group by all")
agg("a_multi_metric", M.orders, [P("o_orderdate", bucket="by_month"), P("o_orderstatus")], [{"op": "count"}, P("o_totalprice", op="max"), P("o_custkey", op="cardinality")],
    """select cast(date_trunc('month', o_orderdate) as date) as o_orderdate, o_orderstatus, count(*) as count, max(cast(o_totalprice as decimal(18,2))) as max_o_totalprice,
    count(distinct o_custkey) as cardinality_o_custkey from orders group by all order by count desc, 1, 2 limit 100""", max_buckets=O.BUCKETS)  # fmt: skip
TOP = "select {0} as value, count(*) as cnt from {1} group by all order by cnt desc, value limit {2}"
query("a_histogram_topk", TOP.format("p_brand", "part", 10))(lambda s, d: O.top_values((of := M.part(s, d)), of.frame, "p_brand", 10))
query("a_chart_distribution", TOP.format("o_orderpriority", "orders", 20))(lambda s, d: O.top_values((of := M.orders(s, d)), of.frame, "o_orderpriority", 20))


@query("a_facets", "select property, value, count(*) as cnt from (select unnest([('c_nationkey', cast(c_nationkey as varchar)), ('c_mktsegment', c_mktsegment)]) as p, p[1] as property, p[2] as value from customer where c_acctbal > 0) group by property, value")
def a_facets(s, d):
    of = M.customer(s, d)
    return O.facets(of, O.select(of, [C("c_acctbal", "gt", value=0)]))


@query("a_link_one", "select o_orderstatus, count(*) as count from orders where o_custkey in (select c_custkey from customer where c_nationkey = 3) group by all")
def a_link_one(s, d):
    link = M.customer_orders(s, d)
    return O.aggregate(link.target, O.follow(link, O.select(link.source, [C("c_nationkey", "eq", value=3)])), [P("o_orderstatus")], [{"op": "count"}], None)


query("a_link_two", f"select l_returnflag, count(*) as count, count(distinct l_partkey) as cardinality_l_partkey {TWO_SQL} group by all")(
    lambda s, d: O.aggregate(M.lineitem(s, d), two(s, d), [P("l_returnflag")], [{"op": "count"}, P("l_partkey", op="cardinality")], None)
)


@query("a_link_type", "select n_name, count(c_custkey) as n_customers, cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(28,2)) as balance from nation left join customer on c_nationkey = n_nationkey group by n_name")
def a_link_type(s, d):
    """Base groups with a linked measure; the linked side is aggregated to the link's key before the join."""
    linked = table(s, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), total("c_acctbal").alias("b"))
    rows = table(s, d, "nation").join(linked, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.groupBy("n_name").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_customers"), F.sum("b").cast("decimal(28,2)").alias("balance"))


@query("a_chart_stacked", "select o_orderpriority, count(*) filter (o_orderstatus = 'F') as F, count(*) filter (o_orderstatus = 'O') as O, count(*) filter (o_orderstatus = 'P') as P from orders group by all")
def a_chart_stacked(s, d):
    """Counts by two groups in wide form; a value that doesn't occur counts 0."""
    return table(s, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0)


@query("a_chart_hierarchy", """select r_name, n_name, cast(grouping(r_name) * 2 + grouping(n_name) as bigint) as level, count(*) as n from customer join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey group by rollup(r_name, n_name)""")  # fmt: skip
def a_chart_hierarchy(s, d):
    rows = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.rollup("r_name", "n_name").agg(F.grouping_id().cast("bigint").alias("level"), F.count("*").alias("n"))


@query("a_chart_histogram", """with b as (select cast(min(o_totalprice) as double) as lo, cast(max(o_totalprice) as double) as hi from orders)
  select cast(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) as bigint) as bin, count(*) as n from orders, b group by 1""")  # fmt: skip
def a_chart_histogram(s, d):
    """Twenty equal bins over the whole set; the last one holds its upper bound."""
    rows = table(s, d, "orders")
    bounds = rows.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    bin_ = F.least(F.floor((F.col("o_totalprice") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / 20)), F.lit(19)).cast("bigint")
    return rows.crossJoin(F.broadcast(bounds)).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))  # bounds: one row


query("a_chart_scatter", "select p_partkey, p_size, p_retailprice from part")(lambda s, d: table(s, d, "part").select("p_partkey", "p_size", "p_retailprice"))


@query("a_bi_calc_column", """select l_returnflag, cast(sum(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2)))) as decimal(38,4)) as net, count(*) as n from lineitem group by all""")
def a_bi_calc_column(s, d):
    rows = table(s, d, "lineitem").withColumn("net_price", F.col("l_extendedprice").cast(M.D) * (1 - F.col("l_discount").cast(M.D)))
    return rows.groupBy("l_returnflag").agg(F.sum("net_price").cast("decimal(38,4)").alias("net"), F.count("*").alias("n"))


W_SQL = """select o_orderkey, row_number() over w as rn, rank() over p as rk, dense_rank() over p as drk, ntile(4) over w as quartile, percent_rank() over p as pr,
  lag(o_totalprice) over w as before, lead(o_totalprice) over w as after, first_value(o_orderkey) over w as first_key,
  last_value(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and unbounded following) as last_key,
  cast(sum(cast(o_totalprice as decimal(18,2))) over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and current row) as decimal(28,2)) as running
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey), p as (partition by o_custkey order by o_orderpriority)"""


@query("w_functions", W_SQL)
def w_functions(s, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    p = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(s, d, "orders").select(
        "o_orderkey",
        F.row_number().over(w).cast("bigint").alias("rn"),
        F.rank().over(p).cast("bigint").alias("rk"),
        F.dense_rank().over(p).cast("bigint").alias("drk"),
        F.ntile(4).over(w).cast("bigint").alias("quartile"),
        F.percent_rank().over(p).alias("pr"),
        F.lag("o_totalprice").over(w).alias("before"),
        F.lead("o_totalprice").over(w).alias("after"),
        F.first("o_orderkey").over(w).alias("first_key"),
        F.last("o_orderkey").over(whole).alias("last_key"),
        F.sum(F.col("o_totalprice").cast(M.D)).over(running).cast("decimal(28,2)").alias("running"),
    )
