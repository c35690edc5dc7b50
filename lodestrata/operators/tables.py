"""Versioned tables as keyed change logs in Parquet.

A write adds a folder of its own with changed rows, marked I, U or D, and then creates the commit file of the next version
whole, which fails if another writer was first; the write then starts again from the new version.  A folder without a commit is
never read.  A version of the table is its last base, without the keys changed since, and the latest change of each of
these.  Where a catalog has tables with UPDATE, MERGE and time travel of its own, these are the native statements.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..shared import create_once, keep, new_path, null_safe

#: ``base_of``: the version whose whole content the folder holds.
COMMIT = "version int, committed_at timestamp_ntz, operation string, n_rows long, n_inserted long, n_updated long, n_deleted long, base_of int, folder string"
#: Times that a write starts again because another one was first.
ATTEMPTS = 20
#: Changes of so many rows at most (some 20 MB of keys) may be broadcast; commits say how many there are.
SMALL_ROWS = 400_000
#: Rows of a file when a table is rewritten by a column of few values.
ROWS_A_FILE = 2_000_000
WIDER = {"tinyint": {"smallint", "int", "bigint"}, "smallint": {"int", "bigint"}, "int": {"bigint", "double"}, "float": {"double"}, "date": {"timestamp_ntz"}}


class ChangeLog:
    """``key`` columns identify a row; ``schema`` is that of the rows."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], schema: StructType):
        self.spark, self.path, self.key, self.schema = spark, path, key, schema

    @classmethod
    def create(cls, rows: DataFrame, key: list[str], at: str, path: str | None = None) -> ChangeLog:
        log = cls(rows.sparkSession, path or new_path(rows.sparkSession, "log"), key, rows.schema)
        log._commit(lambda version: (rows.withColumn("_op", F.lit("I")), version + 1), "CREATE", at)
        return log

    # Reading

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMIT).json(f"{self.path}/commits")

    def _versions(self) -> list:
        """The commits, one row each, by version."""
        try:
            return sorted(self.commits().select("version", "committed_at", "base_of", "n_rows", "folder").collect())
        except Exception as e:  # nothing has been committed yet
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def _rows(self, commits: list) -> DataFrame:
        """The rows of some commits with their version."""
        schema = StructType.fromJson(self.schema.jsonValue()).add("_op", StringType()).add("_folder", StringType())
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/_folder={c['folder']}" for c in commits])
        number = F.create_map(*[F.lit(x) for c in commits for x in (c["folder"], c["version"])])
        return rows.withColumn("_version", number[F.col("_folder")]).drop("_folder")

    def version(self) -> int:
        return max((v["version"] for v in self._versions()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version, by default the last one."""
        known = self._versions()
        version = max((v["version"] for v in known), default=0) if version is None else version
        bases = [v for v in known if v["base_of"] is not None and v["base_of"] <= version]
        if not bases or version not in {v["version"] for v in known}:
            raise ValueError(f"no version {version}, or it has expired")
        base = max(bases, key=lambda v: (v["base_of"], v["version"]))
        changes = [v for v in known if base["base_of"] < v["version"] <= version and v["base_of"] is None and v["n_rows"]]
        rows = self._rows([base]).select(*self.schema.names)
        if not changes:
            return rows
        last = self._rows(changes)
        if len(changes) > 1:  # a commit changes a key once
            others = [c for c in self.schema.names if c not in self.key]
            last = last.groupBy(*self.key).agg(F.max_by(F.struct("_op", *others), "_version").alias("_r"))
            last = last.select(*[F.col(c) if c in self.key else F.col(f"_r.{c}").alias(c) for c in self.schema.names], F.col("_r._op").alias("_op"))
        few = sum(v["n_rows"] for v in changes) <= SMALL_ROWS
        changed = last.select(*self.key)
        return rows.join(F.broadcast(changed) if few else changed, self.key, "left_anti").select(*self.schema.names).union(last.filter("_op <> 'D'").select(*self.schema.names))

    def read_at(self, at: str) -> DataFrame:
        """The table as it was at a time."""
        seen = [v["version"] for v in self._versions() if v["committed_at"] <= _time(at)]
        if not seen:
            raise ValueError(f"no version at {at}")
        return self.read(max(seen))

    def history(self) -> DataFrame:
        return self.commits().select("version", "committed_at", "operation", "n_rows").orderBy("version")

    def snapshots(self) -> DataFrame:
        return self.commits().select("version", "committed_at", "n_inserted", "n_updated", "n_deleted")

    # Writing

    def _commit(self, make, operation: str, at: str, deleted: int | None = None) -> int:
        """Write what ``make(version)`` gives, the changes and which version's whole content they are, as the next version."""
        for _ in range(ATTEMPTS):
            before = self.version()
            changes, base_of = make(before)
            folder = uuid.uuid4().hex
            path = f"{self.path}/rows/_folder={folder}"
            changes.select(*self.schema.names, "_op").write.parquet(path)
            n = self.spark.read.schema("_op string").parquet(path).groupBy().agg(*[F.count_if(F.col("_op") == o).alias(o) for o in "IUD"]).first()
            counts = [n["I"], n["U"], n["D"] if deleted is None else deleted]
            names = [c.split()[0] for c in COMMIT.split(", ")]
            row = dict(zip(names, (before + 1, str(_time(at)), operation, n["I"] + n["U"] + n["D"], *counts, base_of, folder), strict=True))
            if create_once(self.spark, f"{self.path}/commits/{before + 1:09d}.json", json.dumps(row)):
                return before + 1
            self._delete(path)
        raise RuntimeError(f"{ATTEMPTS} other writers were first")

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def update(self, where: Column, changes: dict[str, Column], at: str) -> int:
        new = [changes[c].cast(self.schema[c].dataType).alias(c) if c in changes else F.col(c) for c in self.schema.names]
        return self._commit(lambda version: (self.read(version).filter(where).select(*new).withColumn("_op", F.lit("U")), None), "UPDATE", at)

    def delete(self, where: Column, at: str) -> int:
        return self._commit(lambda version: (self.read(version).filter(where).withColumn("_op", F.lit("D")), None), "DELETE", at)

    def truncate(self, at: str) -> int:
        """An empty base; no row is written."""
        none = self.spark.createDataFrame([], self.schema).withColumn("_op", F.lit("D"))
        return self._commit(lambda version: (none, version + 1), "TRUNCATE", at, deleted=self.read().count())

    def merge(self, source: DataFrame, at: str, matched: dict[str, Column] | None = None, delete_when: Column | None = None) -> int:
        """Update rows whose key is in ``source`` and insert the others; two source rows of one key are refused.

        ``matched`` gives the new values by columns of the source as s_*; by default the source's columns are taken and
        those that it lacks stay.
        """
        keys = source.groupBy(*self.key).agg(F.count("*").alias("_n"))
        n_rows, twice = keys.agg(F.sum("_n"), F.max_by(F.struct(*self.key), F.when(F.col("_n") > 1, F.col("_n")))).first()
        if twice:
            raise ValueError(f"the source has several rows of {twice.asDict()}")
        have = [c for c in source.columns if c in self.schema.names]
        right = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns])
        here = F.col("_here").isNotNull()

        def value(c: str) -> Column:
            new = F.col(f"s_{c}") if c in have else F.lit(None)
            stay = (matched or {}).get(c, F.col(f"s_{c}") if c in have and matched is None else F.col(c))
            return F.when(here, stay if c not in self.key else F.col(f"s_{c}")).otherwise(new).cast(self.schema[c].dataType).alias(c)

        op = F.when(here, F.lit("U")).otherwise(F.lit("I"))
        if delete_when is not None:
            op = F.when(delete_when, F.lit("D")).otherwise(op)

        def make(version: int) -> tuple[DataFrame, None]:
            left = self.read(version).withColumn("_here", F.lit(True))
            if (n_rows or 0) <= SMALL_ROWS:  # find the rows that change where they lie: the table isn't shuffled
                left = left.join(F.broadcast(source.select(*self.key)), self.key, "left_semi")
            joined = right.join(left, reduce(Column.__and__, [left[k] == right[f"s_{k}"] for k in self.key]), "left")
            return joined.select(*[value(c) for c in self.schema.names], op.alias("_op"), here.alias("_h")).filter("_op <> 'D' or _h"), None

        return self._commit(make, "MERGE", at)

    def rollback(self, version: int, at: str) -> int:
        """Append the changes that bring a former version back."""
        others = [c for c in self.schema.names if c not in self.key]

        def make(last: int) -> tuple[DataFrame, None]:
            now, then = self.read(last), self.read(version)
            gone = now.join(then, self.key, "left_anti").withColumn("_op", F.lit("D"))
            old = now.select(*self.key, F.struct(*others).alias("_now"))
            back = then.join(old, self.key, "left").filter(F.col("_now").isNull() | ~F.col("_now").eqNullSafe(F.struct(*others)))
            back = back.select(*self.schema.names, F.when(F.col("_now").isNull(), "I").otherwise("U").alias("_op"))
            return back.unionByName(gone), None

        return self._commit(make, "ROLLBACK", at)

    def expire(self, version: int, at: str) -> int:
        """Forget the versions before ``version``: its content becomes a base, and what only older ones need is deleted.

        Later versions stay as they are.  The commit is a version of its own with the content of the one before it.
        """
        number = self._commit(lambda last: (self.read(version).withColumn("_op", F.lit("I")), version), "EXPIRE", at)
        for old in self._versions():
            if old["version"] <= version and (old["base_of"] is None or old["base_of"] <= version):
                self._delete(f"{self.path}/rows/_folder={old['folder']}")
                if old["version"] < version:
                    self._delete(f"{self.path}/commits/{old['version']:09d}.json")
        return number

    def expire_older(self, older_than: str, at: str, retain_last: int = 1) -> int | None:
        """Expire the versions committed before a time, but for the last ``retain_last``; None if there are none."""
        known = self._versions()
        old = [v["version"] for v in known[: max(0, len(known) - retain_last)] if v["committed_at"] < _time(older_than)]
        return self.expire(known[[v["version"] for v in known].index(max(old)) + 1]["version"], at) if old else None


def _time(at: str):
    import datetime

    return datetime.datetime.fromisoformat(at) if isinstance(at, str) else at


# Schemas


def add_columns(rows: DataFrame, ddl: str) -> DataFrame:
    """Old rows read null."""
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])


def drop_columns(rows: DataFrame, *names: str) -> DataFrame:
    if missing := [n for n in names if n not in rows.columns]:
        raise ValueError(f"no column {', '.join(missing)}")
    return rows.drop(*names)


def alter_column(rows: DataFrame, name: str, new_name: str | None = None, new_type: str | None = None) -> DataFrame:
    """Rename, or change to a type that holds every value of the old one; others are refused."""
    old = rows.schema[name].dataType.simpleString()
    if new_type and new_type != old and new_type not in WIDER.get(old, ()):
        if not (old.startswith("decimal") and new_type.startswith("decimal") and _wider_decimal(old, new_type)):
            raise ValueError(f"{old} can't become {new_type} without loss")
    out = F.col(name).cast(new_type) if new_type else F.col(name)
    return rows.select(*[out.alias(new_name or name) if c == name else F.col(c) for c in rows.columns])


def _wider_decimal(old: str, new: str) -> bool:
    (p, s), (q, t) = ([int(x) for x in k[8:-1].split(",")] for k in (old, new))
    return t >= s and q - t >= p - s


# Files


def partition_transform(column: str, transform: str, width: int | None = None) -> Column:
    """year, month, day, hour, truncate (numbers), truncate_text or identity as a column to partition by."""
    c = F.col(column)
    formats = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}
    if transform in formats:
        return F.date_format(c, formats[transform])
    if transform == "truncate":
        return c - F.pmod(c, F.lit(width))
    if transform == "truncate_text":
        return F.substring(c, 1, width)
    if transform != "identity":
        raise ValueError(f"unknown transform {transform}")
    return c


def files(spark: SparkSession, path: str) -> DataFrame:
    """``folder, file, bytes, modified`` of the data files below a path; their content isn't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract("path", "([^/]*)$", 1).alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def compact(spark: SparkSession, path: str, to: str, target_bytes: int, min_files: int = 2, partition: str | None = None, where: Column | None = None, least_bytes: int | None = None, most_bytes: int | None = None) -> DataFrame:
    """Rewrite folders with at least ``min_files`` files that are too small or too large into files of about the target size.

    Too small is under ``least_bytes`` (by default the target), too large over ``most_bytes`` (by default no file is).  With
    ``partition``, each of its values is a folder, and ``where`` is a condition on it: others are left.  The new folder
    ``to`` holds the whole table: what needs no rewriting is copied as it lies, one task for each of its files or parts of
    them.  Where nothing needs rewriting nothing is written, and ``path`` remains the table.

    Returns ``folder, files_before, bytes_before, files_after`` of what was rewritten; rows stay as they are.
    """
    odd = F.col("bytes") < (target_bytes if least_bytes is None else least_bytes)
    if most_bytes is not None:
        odd |= F.col("bytes") > most_bytes
    found = files(spark, path).groupBy("folder").agg(F.count("*").alias("files_before"), F.sum("bytes").alias("bytes_before"), F.count_if(odd).alias("n_odd"))
    rows = spark.read.parquet(path)
    if partition:
        value = F.url_decode(F.replace(F.regexp_extract("folder", f"{partition}=([^/]*)", 1), F.lit("+"), F.lit("%2B")))
        found = found.withColumn("_value", F.when(value != "__HIVE_DEFAULT_PARTITION__", value).cast(rows.schema[partition].dataType))
    if where is not None:
        found = found.withColumn(partition, F.col("_value")).filter(where).drop(partition)
    plan = keep(found.filter(F.col("n_odd") >= min_files).withColumn("files_after", F.ceil(F.col("bytes_before") / F.lit(target_bytes)).cast("int")), "plan")
    total = plan.agg(F.sum("files_after")).first()[0]
    if total and partition:
        parts = plan.select(F.col("_value").alias(partition), "files_after")
        spread = null_safe(rows, parts, [partition], "left")
        whole = spread.filter("files_after is null").drop("files_after")
        dealt = spread.filter("files_after is not null").withColumn("_file", F.pmod(F.xxhash64(*rows.columns), "files_after")).repartitionByRange(total, partition, "_file")
        dealt.drop("_file", "files_after").write.mode("overwrite").partitionBy(partition).parquet(to)
        whole.write.mode("append").partitionBy(partition).parquet(to)
    elif total:
        rows.repartition(total).write.mode("overwrite").parquet(to)
    return plan.select("folder", "files_before", "bytes_before", "files_after")


def spread(rows: DataFrame, columns: list[str], rows_a_file: int | None = None) -> DataFrame:
    """Rows dealt by ``columns`` for writing, a value with many rows to as many tasks as it fills files."""
    most = rows_a_file or ROWS_A_FILE
    large = keep(rows.groupBy(*columns).agg(F.count("*").alias("_n")).filter(F.col("_n") > most), "large")
    n = large.count()
    if not n:
        return rows.repartition(*columns)
    known = large.select(*columns, F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    dealt = rows.join(F.broadcast(known) if n <= SMALL_ROWS else known, columns, "left").withColumn("_salt", F.when(F.col("_parts") > 1, F.pmod(F.xxhash64(*rows.columns), "_parts")))
    return dealt.repartition(*columns, "_salt").select(*rows.columns)


def orphans(spark: SparkSession, log: ChangeLog, older_than: str) -> DataFrame:
    """``folder, file, bytes``: files of a log that no commit refers to and that are older than the time given."""
    found = files(spark, f"{log.path}/rows").withColumn("own", F.regexp_extract("folder", "_folder=([^/]*)", 1))
    old = found.filter(F.col("modified") < F.lit(older_than).cast("timestamp"))
    return old.join(log.commits().select(F.col("folder").alias("own")), "own", "left_anti").select("folder", "file", "bytes")


def remove_orphans(spark: SparkSession, log: ChangeLog, older_than: str) -> int:
    """Delete the folders of orphans, one for each write that failed; how many there were."""
    gone = [r["folder"] for r in orphans(spark, log, older_than).select("folder").distinct().collect()]
    for folder in gone:
        log._delete(folder)
    return len(gone)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
