"""Queries of governance as data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import govern as G
from ..operators import objects as O
from ..shared import keep
from .registry import query, table

query("sec_row_policy", "select * from customer where c_nationkey in (1, 2, 3)")(lambda s, d: G.Governed(table(s, d, "customer"), "g_customer_rows").set_rows(F.col("c_nationkey").isin(1, 2, 3)).view())
MASK = "case when c_nationkey = 1 then c_name else '***' end"
query("sec_mask_policy", f"select * replace ({MASK} as c_name) from customer")(lambda s, d: G.Governed(table(s, d, "customer"), "g_customer_mask").set_mask("c_name", MASK).view())


@query("sec_unset", "select * from customer")
def sec_unset(s, d):
    view = G.Governed(table(s, d, "customer"), "g_customer_unset").set_mask("c_name", MASK).set_rows(F.col("c_nationkey") == 1)
    view.view()
    return view.set_mask("c_name", None).set_rows(None).view()


@query("sec_role_map", "select * from customer where c_nationkey in (select n_nationkey from nation where n_regionkey = 2)")
def sec_role_map(s, d):
    """The analyst of a region sees its nations, by a mapping table."""
    allowed = table(s, d, "nation").select(F.concat(F.lit("analyst_"), F.col("n_regionkey").cast("string")).alias("user"), F.col("n_nationkey").cast("string").alias("value"))
    return G.rows_by_map(table(s, d, "customer"), allowed, "analyst_2", "c_nationkey")


query("cat_search", r"""select distinct doc_id from documents where len(list_filter(string_split_regex(lower(concat_ws(' ', source, text)), '[^\p{L}\p{N}]+'), lambda w: starts_with(w, 'src1'))) > 0
  and len(list_filter(string_split_regex(lower(concat_ws(' ', source, text)), '[^\p{L}\p{N}]+'), lambda w: starts_with(w, 'that'))) > 0""")(lambda s, d: G.search(table(s, d, "documents"), "doc_id", ["source", "text"], "SRC1 that"))  # fmt: skip


@query("cat_facets", "select 'lang' as property, lang as value, count(*) as cnt from documents where n_chars > 500 group by lang union all select 'source', source, count(*) from documents where n_chars > 500 group by source")
def cat_facets(s, d):
    kinds = {"lang": O.Property("string", role="dimension"), "source": O.Property("string", role="dimension"), "n_chars": O.Property("bigint")}
    of = O.ObjectType("Document", table(s, d, "documents"), ("doc_id",), kinds)
    return O.facets(of, O.select(of, [{"field": "n_chars", "op": "gt", "value": 500}]))


query("cat_browse", "select o_orderstatus as name, count(*) as n from orders where o_orderpriority = '1-URGENT' group by 1")(
    lambda s, d: G.browse(table(s, d, "orders").select(F.concat_ws("/", "o_orderpriority", "o_orderstatus", F.col("o_orderkey").cast("string")).alias("path")), "path", "1-URGENT/")
)
EDGES = "(select o_orderkey as child, cast(o_orderkey // 2 as bigint) as parent from orders where o_orderkey > 0)"


def tree(s, d):
    return table(s, d, "orders").filter("o_orderkey > 0").select(F.col("o_orderkey").alias("src"), F.expr("o_orderkey div 2").alias("dst"))


@query("lin_traverse", f"""with recursive e as (select * from {EDGES}), w as (select max(o_orderkey) as node, 0 as step from orders
  union select e.parent, w.step + 1 from w join e on e.child = w.node) select node, cast(min(step) as integer) as step from w group by node""")  # fmt: skip
def lin_traverse(s, d):
    return G.closure(tree(s, d), table(s, d, "orders").agg(F.max("o_orderkey").alias("node")), keep)


@query("lin_column", f"""with recursive e as (select 'orders.' || child || '.total' as a, 'orders.' || parent || '.total' as b from {EDGES}),
  w as (select 'orders.' || max(o_orderkey) || '.total' as node, 0 as step from orders union select e.b, w.step + 1 from w join e on e.a = w.node) select node, cast(min(step) as integer) as step from w group by node""")  # fmt: skip
def lin_column(s, d):
    """The same closure on columns of tables."""
    name = lambda c: F.concat(F.lit("orders."), F.col(c).cast("string"), F.lit(".total"))
    start = table(s, d, "orders").agg(F.max("o_orderkey").alias("k")).select(name("k").alias("node"))
    return G.closure(tree(s, d).select(name("src").alias("src"), name("dst").alias("dst")), start, keep)


@query("lin_patch", f"""with e as (select child as src, parent as dst, case when child % 5 = 0 then 'manual' else 'automatic' end as origin from {EDGES})
  select * from e where not (origin = 'manual' and src < 50) union all select -1, n_nationkey, 'manual' from nation""")  # fmt: skip
def lin_patch(s, d):
    """Edges of the first fifty are removed, which touches manual ones only; new ones are added, one of them twice."""
    edges = tree(s, d).withColumn("origin", F.when(F.col("src") % 5 == 0, "manual").otherwise("automatic"))
    add = table(s, d, "nation").select(F.lit(-1).cast("bigint").alias("src"), F.col("n_nationkey").cast("bigint").alias("dst"))
    return G.patch_lineage(edges, add.union(add.limit(1)), tree(s, d).filter("src < 50"))


@query("tag_filter", "select p_partkey, p_brand from part where p_size > 40 and p_partkey % 3 <> 0")
def tag_filter(s, d):
    """Parts tagged large; the tag 'old', which was deleted, selects nothing."""
    parts = table(s, d, "part")
    tags = parts.filter("p_size > 40 and p_partkey % 3 <> 0").select("p_partkey", F.lit("large").alias("tag")).union(parts.select("p_partkey", F.lit("old").alias("tag")))
    left = G.drop_tag(tags, "old")
    return G.tagged(parts, left, "p_partkey", "large").join(G.tagged(parts, left, "p_partkey", "old").select("p_partkey"), "p_partkey", "left_anti").select("p_partkey", "p_brand")


@query("fig_verify", """select cast(n_nationkey as bigint) as claim_id, 'verified' as status from nation union all select cast(100 + n_nationkey as bigint), 'derived' from nation where n_nationkey > 0
  union all select cast(200 + n_nationkey as bigint), 'unverified' from nation""")  # fmt: skip
def fig_verify(s, d):
    """A report quotes totals by nation, their sums with the first nation's, and figures that are made up."""
    sums = table(s, d, "customer").groupBy("c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("t"))
    totals = table(s, d, "nation").join(sums, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("n_nationkey").cast("bigint").alias("k"), F.coalesce("t", F.lit(0.0)).alias("t"))
    totals = totals.withColumn("t", F.col("t") + F.col("k") * 10_000_000.0)  # apart from each other
    first = totals.filter("k = 0").select(F.col("t").alias("t0"))
    both = totals.crossJoin(F.broadcast(first))  # one row
    claims = totals.select(F.col("k").alias("claim_id"), F.col("t").alias("figure")).union(both.filter("k > 0").select(F.col("k") + 100, F.col("t") + F.col("t0"))).union(totals.select(F.col("k") + 200, F.col("t") + 3_333_333.33))
    return G.verify_figures(claims, totals.select(F.col("k").alias("cell"), F.col("t").alias("amount")))


ALLOWED = [("draft", "submitted"), ("submitted", "approved"), ("submitted", "rejected"), ("approved", "done")]
STATES = "case event_type when 'signup' then 'draft' when 'view' then 'submitted' when 'click' then 'approved' when 'purchase' then 'done' else 'rejected' end"


@query("req_state", f"""with l as (select user_id as request_id, event_id as seq, {STATES} as state, event_id % 7 as actor from events),
  m as (select *, coalesce(lag(state) over w, 'draft') as before, last_value(case when state = 'submitted' then actor end ignore nulls) over (partition by request_id order by seq rows between unbounded preceding and 1 preceding) as submitter
    from l window w as (partition by request_id order by seq)),
  v as (select *, (before, state) in (('draft', 'submitted'), ('submitted', 'approved'), ('submitted', 'rejected'), ('approved', 'done')) and not coalesce(state = 'approved' and actor = submitter, false) as ok from m)
  select request_id, coalesce(arg_max(state, seq) filter (ok), 'draft') as state, count(*) filter (not ok) as n_rejected from v group by request_id""")  # fmt: skip
def req_state(s, d):
    log = table(s, d, "events").select(F.col("user_id").alias("request_id"), F.col("event_id").alias("seq"), F.expr(STATES).alias("state"), (F.col("event_id") % 7).alias("actor"))
    return G.request_states(log, ALLOWED)
