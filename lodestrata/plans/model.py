"""The object types, links and derived frames that the registered queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.objects import DatePolicy, LinkType, ObjectType, Property
from .registry import table

D = "decimal(18,2)"
DIM = {"aggregatable": True, "role": "dimension"}
NUM = {"aggregatable": True, "role": "measurement"}


def customer(s: SparkSession, d: str) -> ObjectType:
    p = {
        "c_custkey": Property("bigint"),
        "c_name": Property("string", searchable=True),
        "c_nationkey": Property("int", **DIM),
        "c_acctbal": Property(D, **NUM, hidden=True),
        "c_mktsegment": Property("string", **DIM),
    }
    return ObjectType("Customer", table(s, d, "customer"), ("c_custkey",), p)


def orders(s: SparkSession, d: str) -> ObjectType:
    p = {
        "o_orderkey": Property("bigint"),
        "o_custkey": Property("bigint", **DIM | {"role": "none"}),
        "o_orderstatus": Property("string", **DIM),
        "o_totalprice": Property(D, **NUM),
        "o_orderdate": Property("timestamp_ntz", aggregatable=True),
        "o_orderpriority": Property("string", **DIM),
    }
    return ObjectType("Order", table(s, d, "orders"), ("o_orderkey",), p)


def lineitem(s: SparkSession, d: str) -> ObjectType:
    names = {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": D, "l_extendedprice": D,
        "l_discount": D, "l_tax": D, "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    }
    p = {n: Property(k, aggregatable=True, role="dimension" if k == "string" else "none") for n, k in names.items()}
    return ObjectType("LineItem", table(s, d, "lineitem"), ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), p, require_filter=True)


def part(s: SparkSession, d: str) -> ObjectType:
    p = {"p_partkey": Property("bigint"), "p_name": Property("string", searchable=True), "p_brand": Property("string", **DIM), "p_type": Property("string", **DIM), "p_size": Property("int", **NUM), "p_retailprice": Property(D, **NUM)}
    return ObjectType("Part", table(s, d, "part"), ("p_partkey",), p)


def supplier(s: SparkSession, d: str) -> ObjectType:
    p = {"s_suppkey": Property("bigint"), "s_name": Property("string", searchable=True), "s_nationkey": Property("int", **DIM), "s_acctbal": Property(D, **NUM)}
    return ObjectType("Supplier", table(s, d, "supplier"), ("s_suppkey",), p)


def nation(s: SparkSession, d: str) -> ObjectType:
    p = {"n_nationkey": Property("int"), "n_name": Property("string", searchable=True), "n_regionkey": Property("int", **DIM)}
    return ObjectType("Nation", table(s, d, "nation"), ("n_nationkey",), p)


def customer_orders(s, d) -> LinkType:
    return LinkType("customer_orders", customer(s, d), orders(s, d), (("c_custkey", "o_custkey"),))


def order_lines(s, d) -> LinkType:
    return LinkType("order_lines", orders(s, d), lineitem(s, d), (("o_orderkey", "l_orderkey"),))


def balance_frame(s, d) -> DataFrame:
    rows = table(s, d, "orders")
    return rows.groupBy("o_custkey", F.to_date("o_orderdate").alias("snap_date")).agg(F.sum(F.col("o_totalprice").cast(D)).cast("decimal(28,2)").alias("balance"))


BALANCE_SQL = """balance as (select o_custkey, cast(o_orderdate as date) as snap_date,
  cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as balance from orders group by all)"""


def balance(s, d) -> ObjectType:
    p = {"o_custkey": Property("bigint"), "snap_date": Property("date"), "balance": Property("decimal(28,2)", **NUM)}
    return ObjectType("Balance", balance_frame(s, d), ("o_custkey", "snap_date"), p, DatePolicy("snapshot", "snap_date"))


def ranges_frame(s, d) -> DataFrame:
    """Change points of each user's event type as effective ranges."""
    from ..operators.vault import scd2

    return scd2(table(s, d, "events"), ["user_id"], ["event_type"], "ts", "event_id")


RANGES_SQL = """changes as (select user_id, event_type, ts, event_id,
    lag(event_type) over (partition by user_id order by ts, event_id) as prev_type from events),
ranges as (select user_id, event_type, ts as effective_date, lead(ts) over (partition by user_id order by ts, event_id) as expiry_date
  from changes where prev_type is null or prev_type <> event_type)"""


def status_range(s, d) -> ObjectType:
    p = {"user_id": Property("bigint"), "event_type": Property("string", **DIM), "effective_date": Property("timestamp_ntz"), "expiry_date": Property("timestamp_ntz")}
    return ObjectType("Status", ranges_frame(s, d), ("user_id", "effective_date"), p, DatePolicy("effective_range", "effective_date", "expiry_date"))
