"""Ingestion flows: full, incremental, upsert and change data, with state that is saved last.

A flow's state is a small table of JSON rows: the position reached by each table, written only after its data.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import create_once

STATE = "flow string, run int, name string, watermark string, config string, n_rows long"
KEPT_RUNS = 10
DOUBLE_DIGITS = 15


class State:
    """Positions by flow and table; the last ten runs stay readable."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(STATE).json(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], STATE)
            raise

    def kept(self) -> DataFrame:
        last = self.rows().groupBy("flow").agg(F.max("run").alias("last"))
        return self.rows().join(F.broadcast(last), "flow").filter(F.col("run") > F.col("last") - KEPT_RUNS).drop("last")  # one row a flow

    def position(self, flow: str, name: str, config: dict | None = None) -> str | None:
        """The position of a table; none if it is new, was cleared, or its mode, cursor or key changed."""
        last = self.rows().filter((F.col("flow") == flow) & (F.col("name") == name)).orderBy(F.desc("run")).limit(1).collect()
        if not last or (config is not None and last[0]["config"] != fingerprint(config)):
            return None
        return last[0]["watermark"]

    def save(self, flow: str, positions: list[tuple[str, str | None, dict, int]]) -> int:
        """Called after all data of a run is written; two runs can't take one number."""
        run = (self.rows().filter(F.col("flow") == flow).agg(F.max("run")).first()[0] or 0) + 1
        while not create_once(self.spark, f"{self.path}/_claims/{hashlib.sha256(flow.encode()).hexdigest()[:24]}-{run}", flow):
            run += 1
        rows = [(flow, run, name, mark, fingerprint(config), n) for name, mark, config, n in positions]
        self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("append").json(self.path)
        return run

    def clear(self, flow: str, names: list[str]) -> int:
        return self.save(flow, [(n, None, {}, 0) for n in names])


def fingerprint(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:16]


def changed_tables(state: State, flow: str, configs: dict[str, dict]) -> list[str]:
    """Tables that will be read from the start because mode, cursor or key changed."""
    last = state.rows().filter(F.col("flow") == flow).groupBy("name").agg(F.max_by("config", "run").alias("config"))
    held = {r["name"]: r["config"] for r in last.collect()}  # one row a table of the flow
    return sorted(n for n, c in configs.items() if n in held and held[n] != fingerprint(c))


def select_filter(rows: DataFrame, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    rows = rows.filter(where) if where else rows
    return rows.select(*columns) if columns else rows


def past(rows: DataFrame, cursor: str, mark: str | None) -> DataFrame:
    """Rows past a position; deletes aren't seen."""
    return rows if mark is None else rows.filter(F.col(cursor) > F.lit(mark).cast(rows.schema[cursor].dataType))


def watermarks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``name, watermark`` as text: the position each table has been ingested to."""
    out = None
    for name, (rows, cursor) in tables.items():
        part = rows.agg(F.lit(name).alias("name"), F.max(cursor).cast("string").alias("watermark"))
        out = part if out is None else out.union(part)
    return out


def lagging(marks: DataFrame, now: str, minutes: int = 30) -> DataFrame:
    """Tables whose position is older than the limit."""
    late = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("watermark").cast("timestamp"))) / 60
    return marks.withColumn("minutes", F.floor(late).cast("bigint")).filter(F.col("minutes") > minutes)


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by source time and sequence; groups are combined before the shuffle."""
    others = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r")).select(*key, "_r.*").select(rows.columns)


def upsert(target: DataFrame | None, batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The target after a batch; what arrives late but is older than what is stored changes nothing."""
    return latest(batch if target is None else target.unionByName(batch), key, order)


def merge_changes(target: DataFrame | None, changes: DataFrame, key: list[str], order: list[str], hard: bool, op: str = "op", since: str | None = None) -> DataFrame:
    """The stored target after a batch of changes, whatever the order in which batches come.

    Each key has one row with its last ``_op_type``.  Soft: a deleted row stays whole.  Hard: of a deleted row only key and
    ``order`` stay, a tombstone, so that what arrives late doesn't revive the key; an insert after the delete does.  With
    ``since``, a time in the first column of ``order``, changes from before it are refused (see ``too_late``), so that older
    tombstones can be dropped; it mustn't go back from batch to batch.  Changes that tie in ``order`` are ordered by their
    operation and a hash of their values.
    """
    rows = changes.withColumnRenamed(op, "_op_type")
    if since is not None:
        rows = rows.filter(~_before(rows, order, since))
    if target is not None:
        rows = target.unionByName(rows)
    values = [c for c in rows.columns if c not in key]
    last = F.max_by(F.struct(*values), F.struct(*order, "_op_type", F.xxhash64(*values)))
    gone = F.col("_r._op_type") == "d"
    kept = lambda c: F.when(~gone, F.col(f"_r.{c}")).alias(c) if hard and c not in [*order, "_op_type"] else F.col(f"_r.{c}")
    out = rows.groupBy(*key).agg(last.alias("_r")).select(*[F.col(c) if c in key else kept(c) for c in rows.columns])
    return out if since is None or not hard else out.filter((F.col("_op_type") != "d") | ~_before(out, order, since))


def _before(rows: DataFrame, order: list[str], since: str) -> Column:
    """Whether a row is older than a time; a row without a time is."""
    return F.coalesce(F.col(order[0]) < F.lit(since).cast(rows.schema[order[0]].dataType), F.lit(True))


def too_late(changes: DataFrame, order: list[str], since: str) -> DataFrame:
    """The changes that ``merge_changes`` refuses because they are older than what its tombstones cover."""
    return changes.filter(_before(changes, order, since))


def live(target: DataFrame) -> DataFrame:
    """The rows of a stored target that aren't deleted."""
    return target.filter("_op_type <> 'd'").drop("_op_type")


def apply_changes(target: DataFrame | None, changes: DataFrame, key: list[str], order: list[str], hard: bool, op: str = "op") -> DataFrame:
    """Current state from a change log.  Soft: deleted rows stay with ``_op_type`` 'd'.  Hard: they go.

    ``target`` is one that ``merge_changes`` gave; a hard one has tombstones, and its state is returned without them.
    """
    out = merge_changes(target, changes, key, order, hard, op)
    return live(out) if hard else out


def exact_decimal(column: Column, kind: str = "decimal(38,9)") -> Column:
    """Text as a decimal; a value that would be rounded or doesn't fit fails the run."""
    out = column.try_cast(kind)
    scale = int(kind.split(",")[1].rstrip(")"))
    places = F.length(F.regexp_extract(column, r"\.([0-9]*?)0*$", 1))
    return F.when(column.isNull() | (out.isNotNull() & (places <= scale)), out).otherwise(F.raise_error(F.concat(column, F.lit(f" doesn't fit {kind}"))).cast(kind))


def wide_decimal(column: Column) -> Column:
    """Numbers of more than 38 digits stay exact text."""
    return F.regexp_replace(F.trim(column), r"^\+", "")


def preflight(rows: DataFrame) -> DataFrame:
    """``column, declared, digits, finding``: decimals that a double can't hold, by their declaration and their values."""
    found = [f for f in rows.schema if isinstance(f.dataType, T.DecimalType)]
    digits = rows.agg(*[F.max(F.length(F.regexp_replace(F.col(f.name).cast("string"), r"[^0-9]|^-?0+(\.|$)", ""))).cast("long").alias(f.name) for f in found])
    pairs = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("declared"), F.lit(f.dataType.precision).alias("p"), F.col(f.name).alias("digits")) for f in found]))
    finding = F.when(F.col("digits") > DOUBLE_DIGITS, "loses digits").when(F.col("p") > DOUBLE_DIGITS, "may lose digits").otherwise("ok")
    return digits.select(pairs.alias("x")).select("x.column", "x.declared", "x.digits", "x.p").withColumn("finding", finding).drop("p")


def missing_dates(low: str, high: str, done: DataFrame) -> DataFrame:
    """The logical dates from ``low`` to ``high`` that aren't done."""
    every = done.sparkSession.range(1).select(F.explode(F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"))).alias("day"))
    return every.join(done.select(F.col("day").cast("date")), "day", "left_anti")


def backfill(rows: DataFrame, day: str, days: DataFrame, path: str) -> None:
    """Write the rows of the days, each replacing its own partition, so that a rerun changes nothing."""
    chosen = rows.withColumn("day", F.to_date(day)).join(F.broadcast(days), "day", "left_semi")  # one row a day
    chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
