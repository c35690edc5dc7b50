"""Queries of named metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as X
from . import model as M
from .objects import C
from .registry import query, table

CLOSED = [C("o_orderstatus", "eq", value="F")]
SPECS = {
    "value": {"kind": "simple", "op": "sum", "property": "o_totalprice", "fields": ["o_orderpriority"]},
    "n": {"kind": "simple", "op": "count"},
    "closed": {"kind": "simple", "op": "sum", "property": "o_totalprice", "filters": CLOSED},
    "share": {"kind": "ratio", "numerator": "closed", "denominator": "value"},
    "open_value": {"kind": "derived", "formula": "value - closed"},
    "per_order": {"kind": "ratio", "numerator": "value", "denominator": "n"},
    "planned": {"kind": "simple", "op": "count", "status": "catalog_only"},
    "held": {"kind": "simple", "op": "sum", "property": "o_totalprice", "time": "last"},
}
V, VF = "sum(cast(o_totalprice as decimal(18,2)))", "sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) end)"


def registry(s, d) -> X.Metrics:
    return X.Metrics(M.orders(s, d), SPECS)


def exact(rows, *names):
    return rows.withColumns({n: F.col(n).cast("decimal(28,2)") for n in names})


query("m_simple", f"select o_orderpriority, cast({VF} as decimal(28,2)) as closed from orders group by all")(lambda s, d: exact(registry(s, d).query(["closed"], ["o_orderpriority"]), "closed"))
query("m_ratio", f"select o_orderpriority, cast({VF} as double) / cast({V} as double) as share from orders group by all")(lambda s, d: registry(s, d).query(["share"], ["o_orderpriority"]))
query("m_derived", f"select o_orderpriority, cast({V} as double) - cast({VF} as double) as open_value from orders group by all")(lambda s, d: registry(s, d).query(["open_value"], ["o_orderpriority"]))
query("m_named_in_query", f"select o_orderpriority, count(*) as n, cast({V} as double) / cast(count(*) as double) as per_order from orders group by all")(lambda s, d: registry(s, d).query(["n", "per_order"], ["o_orderpriority"]))


@query("m_additivity", f"""select o_orderpriority, count(*) as n, 'additive' as of_n, 'non_additive' as of_share, 'semi_additive' as of_held, 'additive' as of_open from orders group by all""")
def m_additivity(s, d):
    m = registry(s, d)
    m.roll_up_allowed("n", over_time=True)
    kinds = {f"of_{k}": F.lit(m.additivity(n)) for k, n in (("n", "n"), ("share", "share"), ("held", "held"), ("open", "open_value"))}
    return m.query(["n"], ["o_orderpriority"]).withColumns(kinds)


@query("m_filter_inherit", f"""select a.o_orderstatus, a.value, b.n from
  (select o_orderstatus, cast({V} as decimal(28,2)) as value from orders where o_orderpriority = '1-URGENT' group by all) a
  join (select o_orderstatus, count(*) as n from orders where o_orderpriority = '1-URGENT' and o_custkey > 10 group by all) b on a.o_orderstatus = b.o_orderstatus""")  # fmt: skip
def m_filter_inherit(s, d):
    """``value`` takes only the filter on its declared field, ``n`` takes both."""
    return exact(registry(s, d).query(["value", "n"], ["o_orderstatus"], [C("o_orderpriority", "eq", value="1-URGENT"), C("o_custkey", "gt", value=10)]), "value")


@query("m_semi_additive", f"""with {M.BALANCE_SQL}, e as (select o_custkey, cast(date_trunc('month', snap_date) as date) as period, arg_max(balance, snap_date) as v from balance group by all)
  select period, cast(sum(v) as decimal(38,2)) as balance from e group by period""")  # fmt: skip
def m_semi_additive(s, d):
    return X.semi_additive(M.balance_frame(s, d), ["o_custkey"], "snap_date", "balance", "month").withColumn("balance", F.col("balance").cast("decimal(38,2)"))


query("m_asof_latest", f"with {M.BALANCE_SQL} select * from balance where snap_date = (select max(snap_date) from balance)")(lambda s, d: X.as_of_rule(M.balance_frame(s, d), "snap_date", "latest"))
query("m_asof_selected", f"with {M.BALANCE_SQL} select * from balance where snap_date = date '1997-03-03'")(lambda s, d: X.as_of_rule(M.balance_frame(s, d), "snap_date", "selected_date", "1997-03-03"))
query("m_asof_period_end", f"with {M.BALANCE_SQL} select * from balance where snap_date = (select max(snap_date) from balance where snap_date <= date '1997-03-31')")(
    lambda s, d: X.as_of_rule(M.balance_frame(s, d), "snap_date", "period_end", "1997-03-31")
)
TO_DATE_SQL = " union all ".join(
    f"select '{r}' as rule, count(*) as n, cast({V} as decimal(28,2)) as value from orders where cast(o_orderdate as date) <= date '1998-05-20'" + (f" and cast(o_orderdate as date) >= cast(date_trunc('{u}', date '1998-05-20') as date)" if u else "")
    for r, u in X.TO_DATE.items()
)


@query("m_to_date", TO_DATE_SQL)
def m_to_date(s, d):
    return X.to_dates(table(s, d, "orders"), "o_orderdate", "1998-05-20", {"n": F.lit(1).cast("long"), "value": F.col("o_totalprice").cast(M.D)}).withColumn("value", F.col("value").cast("decimal(28,2)"))


@query("m_growth", f"""with m as (select o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as month, cast({V} as decimal(28,2)) as value from orders group by all),
  g as (select *, lag(value) over (partition by o_orderpriority order by month) as previous from m)
  select *, case when previous <> 0 then (cast(value as double) - cast(previous as double)) / cast(previous as double) end as growth_rate from g""")  # fmt: skip
def m_growth(s, d):
    monthly = table(s, d, "orders").groupBy("o_orderpriority", F.date_trunc("month", "o_orderdate").cast("date").alias("month")).agg(F.sum(F.col("o_totalprice").cast(M.D)).cast("decimal(28,2)").alias("value"))
    return X.growth(monthly, "month", "value", ["o_orderpriority"])


@query("m_direct", "select o_orderpriority, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as quantity from orders join lineitem on o_orderkey = l_orderkey group by all")
def m_direct(s, d):
    rows = table(s, d, "orders").join(table(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast(M.D)).cast("decimal(28,2)").alias("quantity"))


@query("m_agg_then_join", """with l as (select l_orderkey as o_orderkey, count(*) as n_lines, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(28,2)) as quantity from lineitem group by 1),
  o as (select o_orderkey, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as value from orders group by 1) select o.*, n_lines, quantity from o left join l using (o_orderkey)""")  # fmt: skip
def m_agg_then_join(s, d):
    sums = lambda c, n: F.sum(F.col(c).cast(M.D)).cast("decimal(28,2)").alias(n)
    return X.aggregate_then_join([(table(s, d, "orders"), ["o_orderkey"], [sums("o_totalprice", "value")]), (table(s, d, "lineitem"), ["l_orderkey"], [F.count("*").alias("n_lines"), sums("l_quantity", "quantity")])], ["o_orderkey"])


@query("m_record", f"select count(*) as n, cast({V} as decimal(28,2)) as value from orders where o_custkey = 1 and o_orderdate <= timestamp '1999-01-01'")
def m_record(s, d):
    m = registry(s, d)
    return exact(m.query(["n", "value"], [], rows=X.to_date(m.of.frame, "o_orderdate", "itd", "1999-01-01").filter("o_custkey = 1")), "value")


@query("m_stale_warning", f"with {M.BALANCE_SQL} select *, snap_date as snapshot_date, snap_date < date '2030-01-01' as is_stale from balance where snap_date = (select max(snap_date) from balance)")
def m_stale_warning(s, d):
    return X.stale(X.as_of_rule(M.balance_frame(s, d), "snap_date", "latest"), "snap_date", "2030-01-01")
