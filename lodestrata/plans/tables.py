"""Queries of sinks, versioned tables and their upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tables as T
from ..shared import new_path
from . import model as M
from .registry import query, table

KEY = ["o_orderkey"]
AT = [f"2024-01-0{i} 00:00:00" for i in range(1, 8)]


def base_orders(s, d):
    return table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(M.D).alias("o_totalprice"))


def orders_log(s, d) -> T.ChangeLog:
    return T.ChangeLog.create(base_orders(s, d), KEY, AT[0])


B = "(select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as o_totalprice from orders)"
UPDATED = f"(select * replace (case when o_orderstatus = 'P' then 'F' else o_orderstatus end as o_orderstatus) from {B})"
DELTA = f"(select o_orderkey, o_custkey, 'X' as o_orderstatus, cast(1 as decimal(18,2)) as o_totalprice from {B} where o_orderkey % 10 = 0 union all select o_orderkey + 10000000, o_custkey, 'N', o_totalprice from {B} where o_orderkey % 25 = 0)"


def delta(s, d):
    rows = base_orders(s, d)
    old = rows.filter("o_orderkey % 10 = 0").select("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), F.lit(1).cast(M.D).alias("o_totalprice"))
    return old.union(rows.filter("o_orderkey % 25 = 0").select(F.col("o_orderkey") + 10000000, "o_custkey", F.lit("N"), "o_totalprice"))


def updated(s, d) -> T.ChangeLog:
    log = orders_log(s, d)
    log.update(F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("F")}, AT[1])
    return log


def deleted(s, d) -> T.ChangeLog:
    log = updated(s, d)
    log.delete(F.col("o_totalprice") < 100000, AT[2])
    return log


MERGED = f"(select * from {DELTA} union all select * from {B} where o_orderkey not in (select o_orderkey from {DELTA}))"
query("t_update", f"select * from {UPDATED}")(lambda s, d: updated(s, d).read())
query("t_delete", f"select * from {UPDATED} where o_totalprice >= 100000")(lambda s, d: deleted(s, d).read())
query("t_at_snapshot", f"select * from {UPDATED}")(lambda s, d: deleted(s, d).read(2))
query("t_at_timestamp", f"select * from {B}")(lambda s, d: deleted(s, d).read_at("2024-01-01 12:00:00"))
N = f"select count(*) from {B}"
query("t_history", f"""select 1 as version, timestamp '{AT[0]}' as committed_at, 'CREATE' as operation, ({N}) as n_rows
  union all select 2, timestamp '{AT[1]}', 'UPDATE', ({N} where o_orderstatus = 'P') union all select 3, timestamp '{AT[2]}', 'DELETE', ({N} where o_totalprice < 100000)""")(lambda s, d: deleted(s, d).history())  # fmt: skip
query("t_snapshot_list", f"""select 1 as version, timestamp '{AT[0]}' as committed_at, ({N}) as n_inserted, cast(0 as bigint) as n_updated, cast(0 as bigint) as n_deleted
  union all select 2, timestamp '{AT[1]}', 0, ({N} where o_orderstatus = 'P'), 0 union all select 3, timestamp '{AT[2]}', 0, 0, ({N} where o_totalprice < 100000)""")(lambda s, d: deleted(s, d).snapshots())  # fmt: skip


@query("t_merge", f"select * from {MERGED}")
def t_merge(s, d):
    log = orders_log(s, d)
    log.merge(delta(s, d), AT[1])
    return log.read()


@query("t_truncate", f"select * from {DELTA}")
def t_truncate(s, d):
    """Nothing is left of the old rows when new ones come."""
    log = orders_log(s, d)
    log.truncate(AT[1])
    log.merge(delta(s, d), AT[2])
    return log.read()


@query("t_rollback", f"select * from {UPDATED}")
def t_rollback(s, d):
    log = deleted(s, d)
    log.rollback(2, AT[3])
    return log.read()


@query("t_expire", f"select 2 as version, * from {UPDATED} union all select 3, * from {UPDATED} where o_totalprice >= 100000 union all select 4, * from {UPDATED} where o_totalprice >= 100000")
def t_expire(s, d):
    """The first version goes; the second and those after it read as before."""
    log = deleted(s, d)
    log.expire(2, AT[3])
    try:
        log.read(1)
    except ValueError:
        return log.read(2).select(F.lit(2).alias("version"), "*").union(log.read(3).select(F.lit(3), "*")).union(log.read().select(F.lit(4), "*"))
    raise AssertionError("an expired version can be read")


query("t_add_column", f"select *, cast(null as varchar) as note from {B}")(lambda s, d: T.add_columns(base_orders(s, d), "note string"))
query("t_drop_column", f"select * exclude (o_custkey) from {B}")(lambda s, d: T.drop_columns(base_orders(s, d), "o_custkey"))
query("t_alter_column", f"select o_orderkey, o_custkey, o_orderstatus as status, cast(o_totalprice as decimal(20,4)) as o_totalprice from {B}")(
    lambda s, d: T.alter_column(T.alter_column(base_orders(s, d), "o_orderstatus", "status"), "o_totalprice", new_type="decimal(20,4)")
)


@query("t_partition_evolve", "select l_returnflag, strftime(l_shipdate, '%Y') as year, count(*) as n from lineitem group by all")
def t_partition_evolve(s, d):
    """A table by return flag is rewritten by year of shipping."""
    old, new = new_path(s, "by_flag"), new_path(s, "by_year")
    rows = table(s, d, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    T.spread(rows, ["l_returnflag"]).write.partitionBy("l_returnflag").parquet(old)
    s.read.parquet(old).withColumn("year", T.partition_transform("l_shipdate", "year")).transform(T.spread, ["year"]).write.partitionBy("year").parquet(new)
    return s.read.schema("l_orderkey long, l_shipdate timestamp_ntz, l_returnflag string, year string").parquet(new).groupBy("l_returnflag", "year").agg(F.count("*").alias("n"))


@query("t_compact", "select l_returnflag, count(*) as n, true as fewer from lineitem group by all")
def t_compact(s, d):
    old, new = new_path(s, "many"), new_path(s, "few")
    table(s, d, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag").repartition(12).write.partitionBy("l_returnflag").parquet(old)
    T.compact(s, old, new, 128 << 20, partition="l_returnflag").collect()  # one row a partition
    before, after = (T.files(s, p).groupBy(F.regexp_extract("folder", "l_returnflag=(.*)", 1).alias("l_returnflag")).agg(F.count("*").alias("n_files")) for p in (old, new))
    fewer = before.join(after.withColumnRenamed("n_files", "n_after"), "l_returnflag").select("l_returnflag", (F.col("n_after") < F.col("n_files")).alias("fewer"))
    return s.read.parquet(new).groupBy("l_returnflag").agg(F.count("*").alias("n")).join(fewer, "l_returnflag")


@query("t_orphans", f"select count(*) as n_rows, 1 as n_removed, cast(0 as bigint) as n_left from {B}")
def t_orphans(s, d):
    """The folder of a write that was never committed is found and deleted; the table stays."""
    log = orders_log(s, d)
    base_orders(s, d).withColumn("_op", F.lit("I")).write.parquet(f"{log.path}/rows/_folder=torn")
    removed = T.remove_orphans(s, log, "2100-01-01")
    left = T.orphans(s, log, "2100-01-01").count()
    return log.read().agg(F.count("*").alias("n_rows"), F.lit(removed).alias("n_removed"), F.lit(left).cast("long").alias("n_left"))


@query("t_analyze", "select 'orders' as name, count(*) as n_rows from orders")
def t_analyze(s, d):
    name = T.unique_name("analysed")
    table(s, d, "orders").write.format("parquet").saveAsTable(name)
    s.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS o_orderkey")
    text = next(r["data_type"] for r in s.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Statistics")
    return s.range(1).select(F.lit("orders").alias("name"), F.regexp_extract(F.lit(text), "([0-9]+) rows", 1).cast("bigint").alias("n_rows"))


@query("t_discover", """select 'o_orderkey' as col_name, 'bigint' as data_type, count(o_orderkey) as n, cast(max(o_orderkey) as varchar) as high from orders
  union all select 'o_orderstatus', 'string', count(o_orderstatus), max(o_orderstatus) from orders""")  # fmt: skip
def t_discover(s, d):
    """The columns of a view by the catalog, with what the data have in them."""
    view = T.unique_name("seen")
    rows = table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    rows.createOrReplaceTempView(view)
    known = s.sql(f"DESCRIBE {view}").select("col_name", "data_type")
    one = rows.agg(F.array(*[F.struct(F.lit(c).alias("col_name"), F.count(c).alias("n"), F.max(c).cast("string").alias("high")) for c in rows.columns]).alias("c"))
    return known.join(one.select(F.explode("c").alias("c")).select("c.*"), "col_name")


@query("t_explain", "select true as pushed, true as pruned, count(*) as n from orders where o_totalprice > 1000")
def t_explain(s, d):
    """A query's plan, and the rows it has."""
    view = T.unique_name("explained")
    table(s, d, "orders").createOrReplaceTempView(view)
    text = f"SELECT o_orderkey FROM {view} WHERE o_totalprice > 1000"
    plan = s.sql(f"EXPLAIN FORMATTED {text}").first()[0]
    return s.sql(text).agg(F.lit("GreaterThan(o_totalprice" in plan).alias("pushed"), F.lit("o_custkey" not in plan.split("ReadSchema")[1]).alias("pruned"), F.count("*").alias("n"))


@query("t_merge_branches", f"select * from {DELTA} where o_orderkey >= 10000000 union all select o_orderkey, o_custkey, case when o_orderkey % 10 = 0 then 'X' else o_orderstatus end, o_totalprice from {B} where o_orderkey % 20 <> 0")
def t_merge_branches(s, d):
    """Matched rows are deleted, or updated in one column; the others are inserted."""
    log = orders_log(s, d)
    log.merge(delta(s, d), AT[1], matched={"o_orderstatus": F.col("s_o_orderstatus")}, delete_when=(F.col("s_o_orderkey") % 20 == 0) & F.col("_here").isNotNull())
    return log.read()


@query("t_drop_table", "select 'dropped' as name, count(*) as n from orders")
def t_drop_table(s, d):
    """Of two tables one is dropped; the other still shows and has its rows."""
    kept, gone = T.unique_name("kept"), T.unique_name("gone")
    for name in (kept, gone):
        table(s, d, "orders").select("o_orderkey").write.format("parquet").saveAsTable(name)
    s.sql(f"DROP TABLE {gone}")
    shown = [r["tableName"] for r in s.sql("SHOW TABLES").filter(F.col("tableName").isin(kept, gone)).collect()]
    return s.table(kept).agg(F.lit("dropped" if shown == [kept] else "not dropped").alias("name"), F.count("*").alias("n"))


# Sinks

MONTHLY = "select strftime(l_shipdate, '%Y-%m') as month, count(*) as n from lineitem group by all"


@query("sink_ctas", "select o_orderstatus, count(*) as n from orders group by all")
def sink_ctas(s, d):
    name = T.unique_name("ctas")
    table(s, d, "orders").createOrReplaceTempView("ctas_orders")
    s.sql(f"CREATE TABLE {name} USING parquet AS SELECT o_orderstatus, count(*) AS n FROM ctas_orders GROUP BY o_orderstatus")
    return s.table(name)


@query("sink_create_replace", "select cast(o_orderdate as date) as day, count(*) as n from orders group by all")
def sink_create_replace(s, d):
    name = T.unique_name("replaced")
    rows = table(s, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    for _ in range(2):
        rows.write.format("parquet").mode("overwrite").saveAsTable(name)
    return s.table(name)


@query("sink_insert", "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'O')")
def sink_insert(s, d):
    name = T.unique_name("inserted")
    rows = table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    rows.filter("o_orderstatus = 'F'").write.format("parquet").saveAsTable(name)
    rows.filter("o_orderstatus = 'O'").write.insertInto(name)
    return s.table(name)


@query("sink_partition_transform", f"""select 'month' as transform, month as part, n from ({MONTHLY})
  union all select 'truncate', cast(l_orderkey - l_orderkey % 1000 as varchar), count(*) from lineitem group by all""")  # fmt: skip
def sink_partition_transform(s, d):
    rows, out = table(s, d, "lineitem"), None
    for name, column in (("month", T.partition_transform("l_shipdate", "month")), ("truncate", T.partition_transform("l_orderkey", "truncate", 1000).cast("string"))):
        path = new_path(s, "transformed")
        rows.select("l_orderkey", column.alias("part")).transform(T.spread, ["part"]).write.partitionBy("part").parquet(path)
        part = s.read.schema("l_orderkey long, part string").parquet(path).groupBy("part").agg(F.count("*").alias("n")).select(F.lit(name).alias("transform"), "part", "n")
        out = part if out is None else out.union(part)
    return out


@query("sink_create_table", "select o_orderkey as transaction_id, o_orderstatus as account_id, cast(o_totalprice as decimal(18,2)) as amount, o_orderdate as txn_time from orders")
def sink_create_table(s, d):
    name = T.unique_name("created")
    s.sql(f"CREATE TABLE {name} (transaction_id BIGINT, account_id STRING, amount DECIMAL(18,2), txn_time TIMESTAMP_NTZ) USING parquet")
    table(s, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast(M.D), "o_orderdate").write.insertInto(name)
    return s.table(name)
