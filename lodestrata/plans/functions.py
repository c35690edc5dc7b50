"""Queries of scalar and SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from . import model as M
from .registry import query, table


def fn(name: str, of: str, key: list[str], sql: str | None, **columns):
    """Columns over one table; ``sql`` has their expressions in DuckDB's SQL."""
    text = f"select {', '.join(key)}, {sql} from {of}" if sql else None
    query(name, text)(lambda s, d: table(s, d, of).select(*key, *[(c() if callable(c) else c).alias(n) for n, c in columns.items()]))


C, CK, OK = F.col, ["c_custkey"], ["o_orderkey"]
LK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
fn("fn_concat", "customer", CK, "c_name || '-' || c_mktsegment as x", x=lambda: F.concat("c_name", F.lit("-"), "c_mktsegment"))
fn("fn_substr", "customer", CK, "substr(c_name, 3, 5) as x", x=lambda: F.substr("c_name", F.lit(3), F.lit(5)))
fn("fn_upper_lower", "customer", CK, "upper(c_name) as u, lower(c_name) as l", u=lambda: F.upper("c_name"), l=lambda: F.lower("c_name"))
fn("fn_trim", "customer", CK, "trim('  ' || c_name || ' ') as x", x=lambda: F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))))
fn("fn_regexp_replace", "customer", CK, "regexp_replace(c_name, '[0-9]', 'd', 'g') as x", x=lambda: F.regexp_replace("c_name", "[0-9]", "d"))
fn("fn_round", "lineitem", LK, "round(cast(l_extendedprice as decimal(18,2)), 1) as x", x=lambda: F.round(C("l_extendedprice").cast(M.D), 1).cast("decimal(18,1)"))
fn("fn_abs", "customer", CK, "abs(c_acctbal) as x", x=lambda: F.abs("c_acctbal"))
fn("fn_mod", "orders", OK, "o_orderkey % 7 as x", x=lambda: C("o_orderkey") % 7)
fn("fn_ceil_floor", "lineitem", LK, "cast(ceil(l_extendedprice) as bigint) as c, cast(floor(l_extendedprice) as bigint) as f", c=lambda: F.ceil("l_extendedprice"), f=lambda: F.floor("l_extendedprice"))
fn("fn_current_date", "orders", OK, None, ok=lambda: F.current_date() >= C("o_orderdate").cast("date"))
fn("fn_current_timestamp", "orders", OK, None, load_ts=lambda: F.current_timestamp())
fn("fn_date_add", "orders", OK, "cast(o_orderdate as date) + 30 as x", x=lambda: F.date_add("o_orderdate", 30))
fn("fn_date_trunc", "orders", OK, "cast(date_trunc('day', o_orderdate) as timestamp) as x", x=lambda: F.date_trunc("day", "o_orderdate").cast("timestamp_ntz"))
fn("fn_to_date", "orders", OK, "cast(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') as date) as x", x=lambda: F.to_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy"))
fn("fn_cast", "lineitem", LK, "cast(l_quantity as integer) as i, cast(l_linenumber as varchar) as t, try_cast(l_returnflag as integer) as bad", i=lambda: C("l_quantity").cast("int"), t=lambda: C("l_linenumber").cast("string"), bad=lambda: C("l_returnflag").try_cast("int"))
fn("fn_to_char", "lineitem", LK, "printf('%.2f', cast(l_extendedprice as decimal(18,2))) as n, strftime(l_shipdate, '%Y-%m') as m", n=lambda: F.trim(F.to_char(C("l_extendedprice").cast("decimal(12,2)"), F.lit("9999999990.00"))), m=lambda: F.date_format("l_shipdate", "yyyy-MM"))
fn("fn_to_number", "events", ["event_id"], "cast(json_extract_string(props, '$.k') as decimal(5,0)) as x", x=lambda: F.to_number(F.get_json_object("props", "$.k"), F.lit("99999")))
fn("fn_array_contains", "part", ["p_partkey"], "list_contains(string_split(p_name, ' '), 'red') as x", x=lambda: F.array_contains(F.split("p_name", " "), "red"))
fn("fn_map", "events", ["event_id"], "map_keys(map([event_type], [value]))[1] as k, map_extract(map([event_type], [value]), 'view')[1] as v", k=lambda: F.map_keys(F.create_map("event_type", "value"))[0], v=lambda: F.try_element_at(F.create_map("event_type", "value"), F.lit("view")))
fn("fn_struct", "orders", OK, "o_totalprice as p, 'X' as x, o_orderstatus as s", p=lambda: F.struct(C("o_totalprice").alias("p")).getField("p"), x=lambda: F.struct(C("o_orderstatus").alias("s")).withField("s", F.lit("X")).getField("s"), s=lambda: F.struct(C("o_orderstatus").alias("s")).getField("s"))
fn("fn_interval", "orders", OK, "o_orderdate + interval 1 day as d, o_orderdate > timestamp '1997-06-01 00:00:00' as late", d=lambda: C("o_orderdate") + F.expr("interval '1' day"), late=lambda: C("o_orderdate") > F.expr("timestamp_ntz'1997-06-01 00:00:00'"))
fn("fn_query_user", "customer", CK, "'analyst' as asked_by", asked_by=lambda: S.query_user("analyst"))
fn("fn_mask", "customer", CK, "repeat('*', greatest(length(c_name) - 4, 0)) || right(c_name, 4) as tail, translate(c_mktsegment, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', repeat('X', 26)) as full", tail=lambda: S.mask_tail(C("c_name")), full=lambda: F.mask("c_mktsegment"))
fn("fn_sha256_hex", "customer", CK, "sha256(upper(trim(c_name))) as x", x=lambda: S.sha256_hex(C("c_name")))


@query("fn_flatten", "select p_partkey, unnest(string_split(p_name, ' ')) as word from part")
def fn_flatten(s, d):
    return S.flatten(table(s, d, "part").select("p_partkey", F.split("p_name", " ").alias("words")), "words", "word").drop("words")


@query("udf_sql_scalar", "select c_custkey, case when c_acctbal < 0 then 'debit' else 'credit' end as side from customer")
def udf_sql_scalar(s, d):
    S.create_function(s, "side_of", "v DOUBLE", "STRING", "CASE WHEN v < 0 THEN 'debit' ELSE 'credit' END")
    return table(s, d, "customer").select("c_custkey", F.expr("side_of(c_acctbal)").alias("side"))


@query("udf_drop_describe", "select o_orderkey, o_totalprice * 2 as twice, true as described from orders")
def udf_drop_describe(s, d):
    S.create_function(s, "twice_of", "v DOUBLE", "DOUBLE", "v * 2")
    text = " ".join(r[0] for r in s.sql("DESCRIBE FUNCTION twice_of").collect())
    rows = table(s, d, "orders").select("o_orderkey", F.expr("twice_of(o_totalprice)").alias("twice"), F.lit("twice_of" in text).alias("described"))
    s.sql("DROP TEMPORARY FUNCTION twice_of")
    return rows


@query("udf_policy", "select c_custkey, case when c_nationkey = 1 then c_name else '***' end as c_name from customer")
def udf_policy(s, d):
    from ..operators.govern import mask_by

    S.create_function(s, "masked_name", "name STRING, nation INT", "STRING", "CASE WHEN nation = 1 THEN name ELSE '***' END")
    return mask_by(table(s, d, "customer"), {"c_name": "masked_name(c_name, c_nationkey)"}).select("c_custkey", "c_name")


@query("tvf_metadata", "select 1 as version, 'CREATE' as operation, count(*) as n_rows from orders union all select 2, 'DELETE', count(*) from orders where o_orderstatus = 'P'")
def tvf_metadata(s, d):
    from .tables import orders_log

    log = orders_log(s, d)
    log.delete(F.col("o_orderstatus") == "P", "2024-01-02 00:00:00")
    return log.history().select("version", "operation", "n_rows")
