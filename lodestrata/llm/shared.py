"""Helpers that the corpus operators share: the shared folder, kept tables and Arrow batches."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of text that one vectorised step works on.
STEP_BYTES = 4 << 20
#: Bytes of an Arrow batch between Spark and its Python workers, but for a longer row.
BATCH_BYTES = 8 << 20


#: Keys with more than this share of all rows are heavy: there are fewer of them than its inverse, whatever the input.
HEAVY_SHARE, HEAVY_LEAST = 1e-4, 64


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset a folder of this machine serves if all executors run in this process; elsewhere that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lodestrata-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``keep`` wrote, once nothing will read it again."""
    for df in frames:
        path = getattr(df, "_kept_path", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffles and broadcasts of past rounds, which it does only after a collection of the driver's heap."""
    spark._jvm.java.lang.System.gc()


def meet(rows: DataFrame, side: DataFrame, key: list[str], weight: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """Join ``rows`` with ``side``, which has one row for each key and in ``weight`` how many rows have it.

    A key with a great part of the rows would bring them all to one task.  Keys over ``HEAVY_SHARE`` of all rows are fewer
    than 1 / ``HEAVY_SHARE``, so their side is broadcast; the rows of all others are dealt by the key.  Reads ``rows``
    twice: keep them before if they are dear.  Rows with a null in the key match nothing; ``how`` is inner or left, and a
    left join leaves them where they are.  ``total`` is the sum of the weights, or more, if it is known.
    """
    if total is None:
        total = side.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    limit = max(HEAVY_LEAST, int(total * HEAVY_SHARE))
    heavy = F.broadcast(side.filter(F.col(weight) > limit))  # fewer than 1 / HEAVY_SHARE rows
    sound = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    rest = rows.filter(sound).join(heavy.select(*key), key, "left_anti").join(side.filter(F.col(weight) <= limit), key, how)
    out = rows.join(heavy, key).unionByName(rest)
    if how == "left":
        gone = [c for c in side.columns if c not in key]
        out = out.unionByName(rows.filter(~sound).select("*", *[F.lit(None).cast(side.schema[c].dataType).alias(c) for c in gone]))
    return out


def local_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table from the driver's values, without Python workers."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds), schema)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts can be long: let the session's Arrow batches hold at most ``rows`` of them and some megabytes.

    Spark reads these settings when it plans a query, which may be long after an operator has returned, so they stay.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def blobs(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [b or b"" for b in texts.cast(kind).to_pylist()]


def strings(texts: pa.Array) -> list[str]:
    return [t or "" for t in texts.to_pylist()]


def steps(sizes: list[int], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that together have about ``most`` bytes; a longer row is a range of its own."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def padded(parts: list[bytes], pad: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte buffer with ``pad`` before each part and after the last; where each part starts and ends."""
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lens + len(pad))
    buffer = np.frombuffer(pad + pad.join(parts) + pad, np.uint8)
    return buffer, ends - lens, ends


def local_components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the undirected edges (u, v)."""
    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        low = np.minimum(a, b)
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
        differ = label[u] != label[v]
        u, v = u[differ], v[differ]
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def worker_state(name: str, make):
    """A value that lives as long as the Python worker, so that later tasks of the same worker find it."""
    store = sys.__dict__.setdefault("_lodestrata_state", {})
    if name not in store:
        store[name] = make()
    return store[name]


def trim() -> None:
    """Give freed memory back to the machine: workers that idle stay beside those that work."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(work):
    """A batch function that trims its worker when a partition ends."""

    def run(batches):
        yield from work(batches)
        trim()

    return run
