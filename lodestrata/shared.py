"""The shared folder of a cluster, and tables kept in it."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which driver and executors share; a folder of our own only in a local session without it."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lodestrata-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str = "kept") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, or leave the one that is there and return False.

    The text goes to a file of another name, which is then renamed without overwriting, so that a writer that dies leaves
    no half-written file under ``path``.  On stores whose rename can't refuse to overwrite, use one writer.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/_part-{uuid.uuid4().hex}")
    system = at.getFileSystem(conf)
    out = system.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(system.makeQualified(part), system.makeQualified(at), none)
        return True
    except Exception:
        system.delete(part, False)
        if system.exists(at):
            return False
        raise


def null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join in which nulls match each other; ``left``'s columns come first, then ``right``'s others."""
    renamed = right.withColumnsRenamed({c: f"_on_{i}" for i, c in enumerate(on)})
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_on_{i}")) for i, c in enumerate(on)])
    return left.join(renamed, match, how).drop(*[f"_on_{i}" for i in range(len(on))])
