"""Queries of data quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from . import model as M
from .joins import ORPHANS_SQL, orphans
from .objects import NULLS_SQL, with_nulls
from .registry import query, table

OUT = "'{0}' as \"check\", '{1}' as target, count(*) = 0 as passed, count(*) as failing_rows, {2} as sample_key"
LK = ["l_orderkey", "l_linenumber"]
query("dq_not_null", f"select {OUT.format('not_null', 'priority', 'min(cast(o_orderkey as varchar))')} from {NULLS_SQL} where priority is null")(lambda s, d: Q.not_null(with_nulls(s, d).frame, "priority", "o_orderkey"))
query("dq_unique", f"""select {OUT.format('unique', 'l_orderkey,l_linenumber', "min(l_orderkey || '|' || l_linenumber)")} from (select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1)""")(
    lambda s, d: Q.unique(table(s, d, "lineitem"), LK)
)
query("dq_relationship", f"select {OUT.format('relationship', 'o_custkey', 'min(cast(o_orderkey as varchar))')} from {ORPHANS_SQL} where o_custkey not in (select c_custkey from customer)")(
    lambda s, d: Q.relationship(orphans(s, d), "o_custkey", table(s, d, "customer"), "c_custkey", "o_orderkey")
)
query("dq_accepted", f"select {OUT.format('accepted', 'o_orderstatus', 'min(cast(o_orderkey as varchar))')} from orders where o_orderstatus not in ('F', 'O')")(
    lambda s, d: Q.accepted(table(s, d, "orders"), "o_orderstatus", ["F", "O"], "o_orderkey")
)


@query("dq_reconcile", """with a as (select cast(date_trunc('month', o_orderdate) as date) as period, sum(cast(o_totalprice as decimal(18,2))) as amount from orders group by 1),
  b as (select cast(date_trunc('month', o_orderdate) as date) as period, sum(cast(o_totalprice as decimal(18,2))) as amount from orders where o_orderkey % 101 <> 0 group by 1)
  select period, cast(coalesce(b.amount, 0) as decimal(28,2)) as amount, cast(coalesce(a.amount, 0) as decimal(28,2)) as amount_source, cast(coalesce(b.amount, 0) - coalesce(a.amount, 0) as decimal(28,2)) as difference
  from b full outer join a using (period)""")  # fmt: skip
def dq_reconcile(s, d):
    rows = table(s, d, "orders")
    out = Q.reconcile(rows.filter("o_orderkey % 101 <> 0"), rows, F.date_trunc("month", "o_orderdate").cast("date"), F.col("o_totalprice").cast(M.D))
    return out.withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("amount", "amount_source", "difference")})


query("dq_freshness", "select max(ts) as latest, cast(floor(epoch(timestamp '2024-02-10' - max(ts)) / 3600) as bigint) as hours, case when epoch(timestamp '2024-02-10' - max(ts)) / 3600 > 720 then 'error' when epoch(timestamp '2024-02-10' - max(ts)) / 3600 > 24 then 'warn' else 'pass' end as status from events")(
    lambda s, d: Q.freshness(table(s, d, "events"), "ts", "2024-02-10 00:00:00", 24, 720)
)
KEY = "user_id"
query("dq_scd2_one_current", f"with {M.RANGES_SQL} select {OUT.format('one_current', KEY, 'min(cast(user_id as varchar))')} from (select user_id from ranges group by user_id having count(*) filter (expiry_date is null) <> 1)")(
    lambda s, d: Q.one_current(M.ranges_frame(s, d), ["user_id"])
)
query("dq_scd2_overlap", f"with {M.RANGES_SQL} select {OUT.format('no_overlap', KEY, 'min(cast(user_id as varchar))')} from (select *, lead(effective_date) over (partition by user_id order by effective_date) as n from ranges) where n is not null and (expiry_date is null or expiry_date > n)")(
    lambda s, d: Q.no_overlap(M.ranges_frame(s, d), ["user_id"], "effective_date", "expiry_date")
)


@query("dq_expect_drop", "select event_id, case when value >= 5 and event_type <> 'error' then 'kept' else 'dropped' end as went from events")
def dq_expect_drop(s, d):
    """Every row goes to the dataset or to the one with the dropped rows."""
    kept, dropped = Q.split(table(s, d, "events"), {"big": ("value >= 5", "drop"), "no_error": ("event_type <> 'error'", "drop")})
    return kept.select("event_id", F.lit("kept").alias("went")).union(dropped.select("event_id", F.lit("dropped").alias("went")))


@query("dq_expect_warn", "select count(*) as n_rows, count(*) filter (l_quantity >= 10) as n_good, count(*) filter (l_quantity < 10) as n_warned from lineitem")
def dq_expect_warn(s, d):
    kept, _ = Q.split(table(s, d, "lineitem"), {"many": ("l_quantity >= 10", "warn")})
    return kept.agg(F.count("*").alias("n_rows"), F.count_if(F.size("warned") == 0).alias("n_good"), F.count_if(F.size("warned") > 0).alias("n_warned"))


@query("dq_history", """with r as (select 1 as run, count(*) as n from orders where o_orderstatus not in ('F') union all select 2, count(*) from orders where o_orderstatus not in ('F', 'O', 'P'))
  select 'accepted' as "check", 'o_orderstatus' as target, 2 as run, (select n = 0 from r where run = 2) as passed, (select n from r where run = 2) as failing_rows, (select count(*) from r where n > 0) as times_failed""")  # fmt: skip
def dq_history(s, d):
    rows = table(s, d, "orders")
    runs = [Q.accepted(rows, "o_orderstatus", values, "o_orderkey").withColumn("run", F.lit(i + 1)) for i, values in enumerate((["F"], ["F", "O", "P"]))]
    return Q.latest_status(runs[0].union(runs[1]))


PROFILE = " union all ".join(
    f"select '{c}' as \"column\", count(*) as n_rows, count(*) - count({c}) as n_nulls, count(distinct {c}) as n_distinct, cast(min({c}) as varchar) as low, cast(max({c}) as varchar) as high, count(distinct {c}) = count(*) as is_key from customer"
    for c in ("c_custkey", "c_name", "c_nationkey")
)
query("dq_key_profile", PROFILE)(lambda s, d: Q.profile(table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey")))


@query("dq_join_profile", """with a as (select o_orderkey as k, count(*) as a from orders where o_orderkey % 3 <> 0 group by 1), b as (select l_orderkey as k, count(*) as b from lineitem group by 1),
  j as (select a, b from a full outer join b on a.k = b.k)
  select cast(sum(a) as bigint) as left_rows, cast(sum(b) as bigint) as right_rows, cast(coalesce(sum(a) filter (b is not null), 0) as bigint) as left_matched, cast(coalesce(sum(b) filter (a is not null), 0) as bigint) as right_matched,
  cast(sum(a * b) as bigint) as joined_rows, cast(sum(a * b) as double) / cast(sum(a) filter (b is not null) as double) as fan_out from j""")  # fmt: skip
def dq_join_profile(s, d):
    return Q.join_profile(table(s, d, "orders").filter("o_orderkey % 3 <> 0"), table(s, d, "lineitem"), [("o_orderkey", "l_orderkey")])


def _automap_sql() -> str:
    columns = {"nation": ["n_nationkey", "n_regionkey"], "region": ["r_regionkey"], "customer": ["c_custkey", "c_nationkey"], "orders": ["o_orderkey", "o_custkey"]}
    flat = [(t, c) for t, own in columns.items() for c in own]
    return " union all ".join(
        f"select '{t}' as \"table\", '{c}' as \"column\", '{kt}' as key_table, '{kc}' as key_column, (select count(distinct {c}) from {t}) as n_values"
        f" where (select count(distinct {kc}) = count(*) from {kt}) and not exists (select 1 from {t} where {c} is not null and {c} not in (select {kc} from {kt}))"
        for t, c in flat for kt, kc in flat if t != kt
    )


query("dq_automap", _automap_sql())(lambda s, d: Q.automap({t: table(s, d, t) for t in ("nation", "region", "customer", "orders")}))
