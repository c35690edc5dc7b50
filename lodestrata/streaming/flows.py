"""Streaming flows: bounded runs that read to the end of a log, and continuous jobs, with the last row of each key as state.

The state store holds the last row of each key, so a micro-batch compares what it reads with that and never reads the
table.  It emits the keys that it read rows of, each with its last row, which a sink adds to its folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..shared import new_path
from ..sources.ingest import latest


def source(spark: SparkSession, path: str, schema, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


class KeyedSink:
    """A table of the last row of each key, as the folders that micro-batches have added.

    A batch has a folder by its run's checkpoint and its number and replaces it as a whole, so that a batch that comes again
    changes nothing.  Reading takes each key's last row by ``order``, not by arrival: a replay from the start, with an empty
    state, adds older rows again, which then change nothing either.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], order: list[str], schema):
        self.spark, self.path, self.key, self.order, self.schema = spark, path, key, order, schema

    def writer(self, checkpoint: str) -> Callable[[DataFrame, int], None]:
        run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.path}/_run={run}/_batch={number}")

        return write

    def read(self) -> DataFrame:
        rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self.path)
        return latest(rows, self.key, self.order)

    def folded(self) -> KeyedSink:
        """A sink of one folder with the same rows, for fewer files to read; streams go on into the new one."""
        out = KeyedSink(self.spark, new_path(self.spark, "sink"), self.key, self.order, self.schema)
        self.read().write.parquet(f"{out.path}/_run=folded/_batch=0")
        return out


def last_of_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """A stream of the last row of each key that a micro-batch has rows of; combined by key before the shuffle.

    The state is one row a key.  Where keys are many, let ``spark.sql.streaming.stateStore.providerClass`` name the RocksDB
    provider before the first run, so that it lies on disk.
    """
    return latest(rows, key, order)


def bounded(rows: DataFrame, checkpoint: str, write) -> StreamingQuery:
    """Read what is there when the run begins, commit, and stop; a second run finds only what is new."""
    query = rows.writeStream.option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return query


def continuous(rows: DataFrame, checkpoint: str, write, every: str = "1 minute") -> StreamingQuery:
    """A job that goes on until it is stopped."""
    return rows.writeStream.option("checkpointLocation", checkpoint).outputMode("update").trigger(processingTime=every).foreachBatch(write).start()


def rows_written(query: StreamingQuery) -> int:
    return sum(p["numInputRows"] for p in query.recentProgress)
