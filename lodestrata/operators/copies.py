"""Materialised copies: raw column subsets and aggregates that answer the queries they cover.

The caller names the base table and a query as dimensions and measures; whether a copy answers it is decided here, by
its columns.  Only states that add up are stored: sums, counts, least and greatest values, and, for the columns named as
``sketched``, HyperLogLog sketches.  These answer ``approx_cardinality`` alone; exact distinct counts use the base table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import keep
from .tables import spread


@dataclass
class RawCopy:
    spark: SparkSession
    path: str
    columns: list[str]
    schema: object = None

    @classmethod
    def build(cls, rows: DataFrame, path: str, columns: list[str], partition: list[str] = (), sort: list[str] = ()) -> RawCopy:
        out = rows.select(*columns)
        if partition:
            out = spread(out, list(partition))
        if sort:
            out = out.sortWithinPartitions(*partition, *sort)
        out.write.mode("overwrite").partitionBy(*partition).parquet(path)
        return cls(rows.sparkSession, path, list(columns), rows.select(*columns).schema)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.columns)


@dataclass
class AggregateCopy:
    """Stores n and, for each column, sum_, count_, min_ and max_, for a sketched one hll_; refreshes go to a new folder."""

    spark: SparkSession
    path: str
    dimensions: list[str]
    columns: list[str]
    version: int
    generation: int = 0
    usable: bool = field(default=True)
    sketched: list[str] = field(default_factory=list)

    @classmethod
    def build(cls, rows: DataFrame, path: str, dimensions: list[str], columns: list[str], version: int, sketched: list[str] = ()) -> AggregateCopy:
        copy = cls(rows.sparkSession, path, list(dimensions), list(columns), version, sketched=list(sketched))
        copy._states(rows).write.parquet(copy._folder())
        return copy

    def _folder(self) -> str:
        return f"{self.path}/generation-{self.generation}"

    def _states(self, rows: DataFrame) -> DataFrame:
        out = [F.count("*").alias("n")]
        for c in self.columns:
            out += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"count_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
        return rows.groupBy(*self.dimensions).agg(*out, *[F.hll_sketch_agg(F.col(c).cast("string")).alias(f"hll_{c}") for c in self.sketched])

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self._folder())

    def merged(self, rows: DataFrame, by: list[str]) -> DataFrame:
        """States rolled up to fewer dimensions."""
        out = [F.sum("n").alias("n")]
        for c in self.columns:
            out += [F.sum(f"sum_{c}").alias(f"sum_{c}"), F.sum(f"count_{c}").alias(f"count_{c}"), F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
        return rows.groupBy(*by).agg(*out, *[F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}") for c in self.sketched])

    def refresh(self, new_rows: DataFrame, version: int) -> None:
        """Add new rows of the source; rows that were changed or deleted need a new build."""
        both = self.merged(self.read().unionByName(self._states(new_rows)), self.dimensions)
        self.generation += 1
        both.write.parquet(self._folder())
        self.version = version

    def covers(self, spec: dict) -> bool:
        known = {"sum", "avg", "min", "max", "count"}
        held = lambda op, c: c in self.sketched if op == "approx_cardinality" else op in known and (c is None or c in self.columns)
        return self.usable and set(spec["dimensions"]) <= set(self.dimensions) and all(held(op, c) for op, c in spec["measures"])


def _name(op: str, column: str | None) -> str:
    return op if column is None else f"{op}_{column}"


def answer(base: DataFrame, spec: dict, copies: list[AggregateCopy]) -> tuple[DataFrame, AggregateCopy | None]:
    """The query's rows and the copy that gave them, the one with the fewest dimensions that covers it, or else the base."""
    fit = sorted((c for c in copies if c.covers(spec)), key=lambda c: len(c.dimensions))
    if not fit:
        sketch = lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string")))
        made = {"approx_cardinality": sketch, "sum": F.sum, "min": F.min, "max": F.max, "cardinality": F.count_distinct, "avg": lambda c: F.sum(c).cast("double") / F.count(c)}
        measures = [(F.count("*") if c is None else F.count(c) if op == "count" else made[op](c)).alias(_name(op, c)) for op, c in spec["measures"]]
        return base.groupBy(*spec["dimensions"]).agg(*measures), None
    rolled = fit[0].merged(fit[0].read(), spec["dimensions"])
    made = {"avg": lambda c: F.col(f"sum_{c}").cast("double") / F.col(f"count_{c}"), "approx_cardinality": lambda c: F.hll_sketch_estimate(f"hll_{c}")}
    value = lambda op, c: F.col("n") if c is None else made[op](c) if op in made else F.col(f"{op}_{c}")
    return rolled.select(*spec["dimensions"], *[value(op, c).alias(_name(op, c)) for op, c in spec["measures"]]), fit[0]


def status(spark: SparkSession, copies: list[tuple[str, AggregateCopy, str, int]]) -> DataFrame:
    """``name, version, source_version, is_stale, refreshed_at, n_rows`` of copies (name, copy, refreshed at, source's version)."""
    rows = [(name, c.version, at, version, c.read().count()) for name, c, at, version in copies]
    out = spark.createDataFrame(rows, "name string, version int, at string, source_version int, n_rows long")
    return out.select("name", "version", "source_version", (F.col("version") < F.col("source_version")).alias("is_stale"), F.col("at").cast("timestamp_ntz").alias("refreshed_at"), "n_rows")


def fresh(statuses: DataFrame, now: str, hours: float) -> DataFrame:
    """Copies that haven't expired."""
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("refreshed_at").cast("timestamp"))
    return statuses.filter(age <= hours * 3600)


def ranked(rows: DataFrame, value: str, name: str, buckets: int = 256) -> DataFrame:
    """Rank of all rows by a value, largest first, ties equal, without sorting all rows in one task.

    Distinct values are counted, dealt to ranges, and summed within a range and over the ranges.
    """
    counts = rows.groupBy(value).agg(F.count("*").alias("_n"))
    ranged = counts.repartitionByRange(buckets, F.desc(value)).withColumn("_p", F.spark_partition_id())
    ranged = keep(ranged, "ranked")
    before = ranged.groupBy("_p").agg(F.sum("_n").alias("_t"))
    before = before.select("_p", (F.sum("_t").over(Window.orderBy("_p")) - F.col("_t")).alias("_before"))  # one row a range
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_p").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = ranged.withColumn("_inside", inside).join(F.broadcast(before), "_p").select(value, (F.col("_before") + F.col("_inside") + 1).alias(name))
    return rows.join(places, value).select(*rows.columns, name)
