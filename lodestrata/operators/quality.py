"""Data quality: checks as frames, quarantine, history and profiles.

Every check gives one row ``check, target, passed, failing_rows, sample_key``; the sample is the least failing key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import keep

#: Below so many distinct values a theta sketch of 4096 entries holds them all; above, its error is about 2 percent.
SURE, SKETCH_ERROR = 3500, 0.1


def _result(failing: DataFrame, check: str, target: str, key: Column | None = None) -> DataFrame:
    sample = F.min((key if key is not None else F.lit(None)).cast("string"))
    return failing.agg(F.lit(check).alias("check"), F.lit(target).alias("target"), (F.count("*") == 0).alias("passed"), F.count("*").alias("failing_rows"), sample.alias("sample_key"))


def not_null(rows: DataFrame, column: str, key: str) -> DataFrame:
    return _result(rows.filter(F.col(column).isNull()), "not_null", column, F.col(key))


def unique(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Failing rows are the keys that occur several times; null keys don't count."""
    full = rows.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))
    twice = full.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1")
    return _result(twice, "unique", ",".join(columns), F.concat_ws("|", *columns))


def relationship(rows: DataFrame, column: str, parent: DataFrame, parent_key: str, key: str) -> DataFrame:
    gone = rows.filter(F.col(column).isNotNull()).join(parent.select(F.col(parent_key).alias("_p")).distinct(), F.col(column) == F.col("_p"), "left_anti")
    return _result(gone, "relationship", column, F.col(key))


def accepted(rows: DataFrame, column: str, values: list, key: str) -> DataFrame:
    return _result(rows.filter(~F.col(column).isin(values)), "accepted", column, F.col(key))


def reconcile(rows: DataFrame, other: DataFrame, period: Column, amount: Column) -> DataFrame:
    """Totals by period on both sides and their difference; a period that one side lacks counts as 0."""
    sums = [r.groupBy(period.alias("period")).agg(F.sum(amount).alias(n)) for r, n in ((rows, "amount"), (other, "amount_source"))]
    both = sums[0].join(sums[1], "period", "full_outer").na.fill(0)
    return both.withColumn("difference", F.col("amount") - F.col("amount_source"))


def freshness(rows: DataFrame, ts: str, now: str, warn_hours: float, error_hours: float) -> DataFrame:
    hours = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max(ts).cast("timestamp"))) / 3600
    out = rows.agg(F.max(ts).alias("latest"), hours.alias("hours"))
    status = F.when(F.col("hours").isNull() | (F.col("hours") > error_hours), "error").when(F.col("hours") > warn_hours, "warn").otherwise("pass")
    return out.select("latest", F.floor("hours").cast("bigint").alias("hours"), status.alias("status"))


def one_current(rows: DataFrame, key: list[str]) -> DataFrame:
    bad = rows.groupBy(*key).agg(F.count_if("is_current").alias("_n")).filter("_n <> 1")
    return _result(bad, "one_current", ",".join(key), F.concat_ws("|", *key))


def no_overlap(rows: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Ranges of a key that go on after the next one begins."""
    after = F.lead(start).over(Window.partitionBy(*key).orderBy(start))
    bad = rows.withColumn("_next", after).filter(F.col("_next").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("_next"))))
    return _result(bad, "no_overlap", ",".join(key), F.concat_ws("|", *key))


def split(rows: DataFrame, rules: dict[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that are dropped, with the names of the rules they failed.

    ``rules`` are {name: (SQL condition, "drop" or "warn")}; a condition that is null fails.  Uniqueness can't be judged
    on one row, so it can only warn: use ``unique``.
    """
    for name, (condition, severity) in rules.items():
        if severity not in ("drop", "warn") or (condition.strip().lower().startswith("unique") and severity == "drop"):
            raise ValueError(f"{name}: unique rules only warn" if severity == "drop" else f"{name}: unknown severity {severity}")
    failed = lambda kind: F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, (c, s) in rules.items() if s == kind] or [F.lit(None).cast("string")]))
    marked = rows.withColumn("failed", failed("drop")).withColumn("warned", failed("warn"))
    return marked.filter(F.size("failed") == 0).drop("failed"), marked.filter(F.size("failed") > 0)


def latest_status(history: DataFrame) -> DataFrame:
    """The last result of each check and target from all runs (``run`` ascends)."""
    return history.groupBy("check", "target").agg(F.max_by(F.struct("run", "passed", "failing_rows"), "run").alias("_r"), F.count_if(~F.col("passed")).alias("times_failed")).select("check", "target", "_r.*", "times_failed")


def sketches(rows: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """One row for each column, in one pass: ``table, column, n_rows, n_nulls, estimate, low, high, sketch``.

    The sketch is a theta sketch of the values, some kilobytes whatever the table; its estimate of the distinct values is
    exact below ``SURE``.
    """

    def one(name: str) -> Column:
        c, kind = F.col(name), rows.schema[name].dataType.typeName()
        if kind not in ("long", "integer"):  # as text that is never empty, which a sketch would pass over
            c = F.concat(F.lit("="), (c + F.lit(0.0) if kind in ("double", "float") else c).cast("string"))
        return F.struct(F.lit(table).alias("table"), F.lit(name).alias("column"), F.count("*").alias("n_rows"), F.count_if(F.col(name).isNull()).alias("n_nulls"), F.min(name).cast("string").alias("low"), F.max(name).cast("string").alias("high"), F.theta_sketch_agg(c).alias("sketch"))

    return rows.agg(F.array(*[one(c) for c in columns]).alias("p")).select(F.explode("p").alias("p")).select("p.*").withColumn("estimate", F.theta_sketch_estimate("sketch"))


def _distinct(tables: dict[str, DataFrame], found: list, wanted) -> dict:
    """Distinct values by table and column: of those ``wanted`` exactly, each counted by a pass that reads it alone."""
    counts, out = {(r["table"], r["column"]): r["estimate"] for r in found}, None
    for r in found:
        if r["estimate"] >= SURE and wanted(r):
            values = tables[r["table"]].select(r["column"]).filter(F.col(r["column"]).isNotNull()).distinct()
            one = values.agg(F.lit(r["table"]).alias("table"), F.lit(r["column"]).alias("column"), F.count("*").alias("n"))
            out = one if out is None else out.union(one)
    return counts if out is None else counts | {(r["table"], r["column"]): r["n"] for r in out.collect()}  # one row a column


def profile(rows: DataFrame, every: bool = True) -> DataFrame:
    """``column, n_rows, n_nulls, n_distinct, low, high, is_key`` of each column.

    One pass sketches all columns.  Those with few values are counted exactly by that; the distinct values of each other
    one are counted by a pass that reads this column alone, so that no row is repeated for each column.  With ``every``
    False only columns that can be keys are counted so, and the others have their estimate.
    """
    found = keep(sketches(rows, rows.columns), "sketches")
    seen = found.select("table", "column", "n_rows", "n_nulls", "estimate").collect()  # one row a column
    exact = _distinct({"": rows}, seen, lambda r: every or _may_be_key(r))
    n_distinct = rows.sparkSession.createDataFrame([(c, n) for (_, c), n in exact.items()], "column string, n_distinct long")
    out = found.join(F.broadcast(n_distinct), "column")
    return out.select("column", "n_rows", "n_nulls", "n_distinct", "low", "high", ((F.col("n_nulls") == 0) & (F.col("n_distinct") == F.col("n_rows"))).alias("is_key"))


def _may_be_key(r) -> bool:
    """Whether a column can be one without repeats and nulls, as far as its sketch tells (its error is about 2 percent)."""
    return r["n_nulls"] == 0 and r["estimate"] >= 0.9 * r["n_rows"]


def join_profile(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Match rates of both sides, fan-out and orphans of a proposed join."""
    a = left.groupBy(*[F.col(x).alias(f"k{i}") for i, (x, _) in enumerate(on)]).agg(F.count("*").alias("a"))
    b = right.groupBy(*[F.col(y).alias(f"k{i}") for i, (_, y) in enumerate(on)]).agg(F.count("*").alias("b"))
    both = a.join(b, [f"k{i}" for i in range(len(on))], "full_outer")
    matched = F.col("a").isNotNull() & F.col("b").isNotNull()
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    out = both.agg(n("a").alias("left_rows"), n("b").alias("right_rows"), n(F.when(matched, F.col("a"))).alias("left_matched"), n(F.when(matched, F.col("b"))).alias("right_matched"), n(F.when(matched, F.col("a") * F.col("b"))).alias("joined_rows"))
    return out.withColumn("fan_out", F.try_divide(F.col("joined_rows").cast("double"), F.col("left_matched").cast("double")))


def automap(tables: dict[str, DataFrame], threshold: float = 1.0) -> DataFrame:
    """Suggested references: columns whose distinct values lie in a key of another table.

    Only columns of whole numbers are tried.  ``key_table, key_column`` is a column without repeats or nulls.  One pass
    over each table sketches its columns.  Columns that can't be keys, and pairs whose sketches differ by more than the
    threshold lets them, drop out: where all of a column's values lie in a key, the sketch of their difference is empty.
    The keys and pairs that are left are verified on their values.
    """
    found, spark = None, next(iter(tables.values())).sparkSession
    for name, rows in tables.items():
        columns = [f.name for f in rows.schema if f.dataType.typeName() in ("long", "integer")]
        if columns:
            part = sketches(rows.select(*[F.col(c).cast("long").alias(c) for c in columns]), columns, name)
            found = part if found is None else found.unionByName(part)
    result = "table string, column string, key_table string, key_column string, n_values long"
    if found is None:
        return spark.createDataFrame([], result)
    found = keep(found, "sketches")
    seen = found.select("table", "column", "n_rows", "n_nulls", "estimate").collect()  # one row a column
    exact = _distinct(tables, seen, _may_be_key)
    keys = [(r["table"], r["column"]) for r in seen if _may_be_key(r) and exact[r["table"], r["column"]] == r["n_rows"] > 0]
    if not keys:
        return spark.createDataFrame([], result)
    own = found.filter("estimate > 0").select("table", "column", "estimate", "sketch", F.lit("whole").alias("kind"))
    of_key = found.join(F.broadcast(spark.createDataFrame(keys, "table string, column string")), ["table", "column"]).select(F.col("table").alias("key_table"), F.col("column").alias("key_column"), F.col("sketch").alias("key_sketch"), F.lit("whole").alias("kind"))
    missing = F.theta_sketch_estimate(F.theta_difference("sketch", "key_sketch")) / F.col("estimate")
    near = missing <= (0.0 if threshold >= 1 else 1 - threshold + SKETCH_ERROR)
    pairs = own.join(of_key, "kind").filter((F.col("table") != F.col("key_table")) & near).select("table", "column", "key_table", "key_column").collect()  # a few a column
    out = None
    for t, c, kt, kc in pairs:
        values = tables[t].select(F.col(c).cast("long").alias("v")).filter("v is not null").distinct()
        key = tables[kt].select(F.col(kc).cast("long").alias("v"), F.lit(1).alias("hit"))
        one = values.join(key, "v", "left").agg(F.lit(t).alias("table"), F.lit(c).alias("column"), F.lit(kt).alias("key_table"), F.lit(kc).alias("key_column"), F.count("*").alias("n_values"), F.count("hit").alias("n_shared"))
        out = one if out is None else out.union(one)
    if out is None:
        return spark.createDataFrame([], result)
    return out.filter((F.col("n_values") > 0) & (F.col("n_shared") >= threshold * F.col("n_values"))).drop("n_shared")
