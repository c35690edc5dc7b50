"""Queries of ingestion flows and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tables as T
from ..shared import keep, new_path
from ..sources import ingest as I
from ..streaming import flows as Z
from . import model as M
from .registry import query, table

ORDERS = "select o_orderkey, o_custkey, o_orderstatus, o_orderdate from orders"
CUT = "1998-01-01 00:00:00"


def few(s, d):
    return table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def log_rows(s, d):
    """Events as a change log: key user_id, order (ts, seq)."""
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    return table(s, d, "events").select("user_id", F.col("event_id").alias("seq"), "ts", F.col("event_type").alias("status"), op.alias("op"))


CDC = """(select user_id, event_id as seq, ts, event_type as status, case when event_type = 'error' then 'd' when event_type = 'signup' then 'c' else 'u' end as _op_type
  from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)"""


@query("i_full_refresh", ORDERS)
def i_full_refresh(s, d):
    path = new_path(s, "full")
    few(s, d).limit(10).write.parquet(path)
    few(s, d).write.mode("overwrite").parquet(path)
    return s.read.parquet(path)


@query("i_incremental", ORDERS)
def i_incremental(s, d):
    """Rows up to a cut, then those past the saved position."""
    path, state = new_path(s, "incremental"), I.State(s, new_path(s, "state"))
    config = {"mode": "incremental", "cursor": "o_orderdate"}
    for rows in (few(s, d).filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")), few(s, d)):
        new = I.past(rows, "o_orderdate", state.position("sales", "orders", config))
        new.write.mode("append").parquet(path)
        state.save("sales", [("orders", s.read.parquet(path).agg(F.max("o_orderdate").cast("string")).first()[0], config, 0)])
    return s.read.parquet(path)


@query("i_append", "select event_id, user_id from events")
def i_append(s, d):
    path, rows = new_path(s, "append"), table(s, d, "events").select("event_id", "user_id")
    for half in (0, 1):
        rows.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(path)
    return s.read.parquet(path)


@query("i_upsert", "select user_id, arg_max(event_id, (ts, event_id)) as event_id, max(ts) as ts, arg_max(event_type, (ts, event_id)) as event_type from events group by user_id")
def i_upsert(s, d):
    rows = table(s, d, "events").select("user_id", "event_id", "ts", "event_type")
    first = I.upsert(None, rows.filter("event_id % 3 = 0"), ["user_id"], ["ts", "event_id"])
    return I.upsert(first, rows.filter("event_id % 3 <> 0"), ["user_id"], ["ts", "event_id"])


query("i_cdc_soft", f"select * from {CDC}")(lambda s, d: I.apply_changes(None, log_rows(s, d), ["user_id"], ["ts", "seq"], hard=False))


@query("i_cdc_hard", f"select * exclude (_op_type) from {CDC} where _op_type <> 'd'")
def i_cdc_hard(s, d):
    """Two batches, each with changes from before and after the other's; tombstones keep deleted keys from coming back."""
    target = None
    for half in (1, 0):
        target = I.merge_changes(target, log_rows(s, d).filter(F.col("seq") % 2 == half), ["user_id"], ["ts", "seq"], hard=True)
        target = target if half == 0 else keep(target, "target")
    return I.live(target)


query("i_current_state", f"select * exclude (_op_type) from {CDC}")(lambda s, d: I.latest(log_rows(s, d).drop("op"), ["user_id"], ["ts", "seq"]))


@query("i_checkpoint", """with d as (select distinct cast(o_orderdate as date) as day from orders order by 1 limit 12)
  select cast(row_number() over (order by day) as integer) as run, cast(day as varchar) as watermark from d qualify run > 2""")
def i_checkpoint(s, d):
    """Twelve runs, of which the last ten stay; a failed run leaves nothing."""
    state = I.State(s, new_path(s, "state"))
    marks = [r["o_orderdate"] for r in few(s, d).select(F.to_date("o_orderdate").cast("string").alias("o_orderdate")).distinct().orderBy("o_orderdate").limit(12).collect()]
    for mark in marks:
        state.save("sales", [("orders", mark, {"mode": "incremental"}, 1)])
    return state.kept().select("run", "watermark")


query("i_table_watermark", "select 'events' as name, cast(max(event_id) as varchar) as watermark from events union all select 'orders', cast(max(o_orderkey) as varchar) from orders")(
    lambda s, d: I.watermarks({"events": (table(s, d, "events"), "event_id"), "orders": (table(s, d, "orders"), "o_orderkey")})
)
query("i_stream_lag", "select 'events' as name, cast(max(ts) as varchar) as watermark, cast(floor(epoch(timestamp '2024-03-01' - max(ts)) / 60) as bigint) as minutes from events")(
    lambda s, d: I.lagging(I.watermarks({"events": (table(s, d, "events"), "ts")}), "2024-03-01 00:00:00")
)


@query("i_reload", ORDERS)
def i_reload(s, d):
    """The target is dropped, the position forgotten and the table read again."""
    path, state = new_path(s, "reload"), I.State(s, new_path(s, "state"))
    state.save("sales", [("orders", "2001-01-01", {}, 1)])
    state.clear("sales", ["orders"])
    I.past(few(s, d), "o_orderdate", state.position("sales", "orders")).write.mode("overwrite").parquet(path)
    return s.read.parquet(path)


@query("i_clear", "select 'customer' as name, cast(max(c_custkey) as varchar) as watermark from customer union all select 'orders', null")
def i_clear(s, d):
    """Only the chosen table loses its position."""
    state = I.State(s, new_path(s, "state"))
    marks = I.watermarks({"customer": (table(s, d, "customer"), "c_custkey"), "orders": (table(s, d, "orders"), "o_orderkey")})
    state.save("sales", [(r["name"], r["watermark"], {}, 1) for r in marks.collect()])
    state.clear("sales", ["orders"])
    return state.rows().groupBy("name").agg(F.max_by("watermark", "run").alias("watermark"))


@query("i_add_table", "select 'orders' as name, count(*) filter (o_orderdate > timestamp '1998-01-01') as n_rows from orders union all select 'customer', count(*) from customer")
def i_add_table(s, d):
    """A new table is read in full, the others go on from their positions."""
    state = I.State(s, new_path(s, "state"))
    state.save("sales", [("orders", CUT, {}, 1)])
    out = None
    for name, cursor in (("orders", "o_orderdate"), ("customer", "c_custkey")):
        part = I.past(table(s, d, name), cursor, state.position("sales", name)).agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"))
        out = part if out is None else out.union(part)
    return out


@query("i_mode_change", "select 'orders' as name, count(*) as n_again from orders")
def i_mode_change(s, d):
    """A changed cursor: the table is listed and read from the start."""
    state = I.State(s, new_path(s, "state"))
    old, new = {"cursor": "o_orderdate"}, {"cursor": "o_orderkey"}
    state.save("sales", [("orders", CUT, old, 1), ("customer", "5", old, 1)])
    changed = I.changed_tables(state, "sales", {"orders": new, "customer": old})
    return I.past(table(s, d, "orders"), "o_orderkey", state.position("sales", "orders", new)).agg(F.lit(",".join(changed)).alias("name"), F.count("*").alias("n_again"))


def event_folder(s, d, parts=3):
    path = new_path(s, "events")
    rows = table(s, d, "events").select("user_id", "event_id", "ts", "event_type")
    rows.filter("event_id % 4 < 3").repartition(parts).write.parquet(path)
    return path, rows


STREAMED = "select user_id, arg_max(event_id, (ts, event_id)) as event_id, max(ts) as ts, arg_max(event_type, (ts, event_id)) as event_type from events group by user_id"


def event_sink(s, rows) -> Z.KeyedSink:
    return Z.KeyedSink(s, new_path(s, "sink"), ["user_id"], ["ts", "event_id"], rows.schema)


@query("i_bounded_stream", STREAMED)
def i_bounded_stream(s, d):
    """Two bounded runs over a growing folder; a third one finds nothing."""
    path, rows = event_folder(s, d)
    sink, checkpoint = event_sink(s, rows), new_path(s, "checkpoint")
    run = lambda: Z.bounded(Z.last_of_key(Z.source(s, path, rows.schema), sink.key, sink.order), checkpoint, sink.writer(checkpoint))
    run()
    rows.filter("event_id % 4 = 3").write.mode("append").parquet(path)
    run()
    if Z.rows_written(run()):
        raise AssertionError("a run without new files read rows")
    return sink.read()


@query("i_stream_job", STREAMED)
def i_stream_job(s, d):
    """After a checkpoint reset all data comes again; the keyed sink stays as it was."""
    path, rows = event_folder(s, d)
    rows.filter("event_id % 4 = 3").write.mode("append").parquet(path)
    sink = event_sink(s, rows)
    for _ in range(2):
        checkpoint = new_path(s, "checkpoint")
        job = Z.continuous(Z.last_of_key(Z.source(s, path, rows.schema), sink.key, sink.order), checkpoint, sink.writer(checkpoint), every="0 seconds")
        try:
            job.processAllAvailable()
        finally:
            job.stop()
    return sink.read()


query("i_select_filter", "select l_orderkey, l_partkey from lineitem where l_returnflag = 'R'")(lambda s, d: I.select_filter(table(s, d, "lineitem"), ["l_orderkey", "l_partkey"], "l_returnflag = 'R'"))


def money_text(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast(M.D).cast("string").alias("amount_text"))


query("i_decimal_exact", "select l_orderkey, l_linenumber, cast(cast(l_extendedprice as decimal(18,2)) as decimal(38,9)) as amount from lineitem")(
    lambda s, d: money_text(s, d).select("l_orderkey", "l_linenumber", I.exact_decimal(F.col("amount_text")).alias("amount"))
)
query("i_decimal_wide_text", "select l_orderkey, l_linenumber, '123456789012345678901234567890123456789' || cast(cast(l_extendedprice as decimal(18,2)) as varchar) as amount from lineitem")(
    lambda s, d: money_text(s, d).select("l_orderkey", "l_linenumber", I.wide_decimal(F.concat(F.lit("+123456789012345678901234567890123456789"), "amount_text")).alias("amount"))
)
query("i_preflight_types", """select 'price' as "column", 'decimal(18,2)' as declared, max(length(cast(cast(round(l_extendedprice * 100) as bigint) as varchar))) as digits, 'may lose digits' as finding from lineitem
  union all select 'quantity', 'decimal(10,2)', max(length(cast(cast(round(l_quantity * 100) as bigint) as varchar))), 'ok' from lineitem""")(  # fmt: skip
    lambda s, d: I.preflight(table(s, d, "lineitem").select(F.col("l_extendedprice").cast(M.D).alias("price"), F.col("l_quantity").cast("decimal(10,2)").alias("quantity")))
)


@query("i_run_stats", "select 'orders' as name, count(*) as n_rows from orders union all select 'customer', count(*) from customer")
def i_run_stats(s, d):
    """Rows written, counted while they are written."""
    from pyspark.sql import Observation

    found = []
    for name in ("orders", "customer"):
        seen = Observation(f"run_{name}")
        table(s, d, name).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(new_path(s, name))
        found.append((name, seen.get["n"]))
    return s.createDataFrame(found, "name string, n_rows long")


@query("i_flow_declarative", "select event_type, count(*) as n, count(distinct user_id) as users from events where value >= 5 group by event_type")
def i_flow_declarative(s, d):
    """A flow declared in SQL: a view, a table that is built from it, and an aggregate of that table."""
    bronze, silver = T.unique_name("bronze"), T.unique_name("silver")
    table(s, d, "events").createOrReplaceTempView(bronze)
    s.sql(f"CREATE TABLE {silver} USING parquet AS SELECT event_type, user_id FROM {bronze} WHERE value >= 5")
    return s.sql(f"SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM {silver} GROUP BY event_type")


@query("i_backfill", "select o_orderkey, cast(o_orderdate as date) as day from orders where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1997-03-01'")
def i_backfill(s, d):
    """Two months by logical date, run twice."""
    path, rows = new_path(s, "backfill"), few(s, d).select("o_orderkey", "o_orderdate")
    none = s.createDataFrame([], "day date")
    for _ in range(2):
        I.backfill(rows, "o_orderdate", I.missing_dates("1997-01-01", "1997-02-28", none), path)
    return s.read.schema("o_orderkey long, day date").parquet(path)
