"""Exact deduplication over a cuckoo index of live digests.

A cuckoo table keeps a short fingerprint of each live digest in one of two buckets.  A fingerprint that hits is checked
against the content key that the same slot stores (the SHA-256 of the normalised text and its length in bytes), so a
chance hit never merges two texts.  An insertion that finds no free slot after ``MAX_MOVES`` moves doubles the table and
deals the stored keys anew.  Deletion empties the slot of a verified hit.

On a cluster the digests are dealt to buckets.  Each input split first folds its own copies in an index of its own, so
that a text with a third of all rows sends at most a few rows from each split; the bucket's index then folds those.

Groups of several rows are then verified by their content: only their texts are read again, and the least and the greatest
text of each digest, combined before the shuffle, must be equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep, lean, meet

SLOTS = 4
MAX_MOVES = 200
#: A split's own index is emptied when it holds so many digests.
SPLIT_DIGESTS = 100_000
#: A table of digests of so many rows at most (about 20 MB) may be broadcast.
SMALL_ROWS = 400_000
GROUPS = "digest binary, bytes long, keep_id long, n long"


class CuckooIndex:
    """Live digests with their length, the id that stays and the number of copies."""

    def __init__(self, capacity: int = 1024):
        self.buckets = 1
        while self.buckets * SLOTS * 0.9 < capacity:
            self.buckets *= 2
        self._empty()

    def _empty(self) -> None:
        self.size = 0
        self.marks = [0] * (self.buckets * SLOTS)  # fingerprints, 0: free
        self.stored: list[list | None] = [None] * (self.buckets * SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def _slot(self, digest: bytes, length: int) -> int:
        """The slot of a verified hit, or -1."""
        mark, one, two = self._places(digest)
        for bucket in (one, two):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.stored[slot][0] == digest and self.stored[slot][1] == length:
                    return slot
        return -1

    def get(self, digest: bytes, length: int) -> list | None:
        slot = self._slot(digest, length)
        return None if slot < 0 else self.stored[slot]

    def add(self, digest: bytes, length: int, keep_id: int | None, n: int) -> None:
        """Insert a digest, or count copies of a live one; the largest id stays (null ids yield to others)."""
        entry = self.get(digest, length)
        if entry is None:
            self._insert([digest, length, keep_id, n])
        else:
            entry[3] += n
            if entry[2] is None or (keep_id is not None and keep_id > entry[2]):
                entry[2] = keep_id

    def remove(self, digest: bytes, length: int) -> bool:
        """Delete a live digest; False if it isn't live."""
        slot = self._slot(digest, length)
        if slot >= 0:
            self.marks[slot], self.stored[slot] = 0, None
            self.size -= 1
        return slot >= 0

    def _insert(self, entry: list) -> None:
        self.size += 1
        mark, one, two = self._places(entry[0])
        bucket = one
        for move in range(MAX_MOVES):
            for at in (bucket, two) if move == 0 else (bucket,):
                for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                    if not self.marks[slot]:
                        self.marks[slot], self.stored[slot] = mark, entry
                        return
            slot = bucket * SLOTS + (move + mark) % SLOTS
            self.marks[slot], mark, self.stored[slot], entry = mark, self.marks[slot], entry, self.stored[slot]
            bucket = self._other(bucket, mark)
        self._grow(entry)

    def _grow(self, extra: list) -> None:
        entries = [*self, extra]
        self.buckets *= 2
        self._empty()
        for entry in entries:
            self._insert(entry)

    def __iter__(self) -> Iterator[list]:
        return (entry for entry in self.stored if entry is not None)

    def __len__(self) -> int:
        return self.size


def _batch(entries: list[list]) -> pa.RecordBatch:
    columns = list(zip(*entries, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["digest", "bytes", "keep_id", "n"])


def _fold(limit: int | None):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index.add(*row)
            if limit and len(index) >= limit:
                yield _batch(list(index))
                index = CuckooIndex()
        entries = list(index)
        for i in range(0, len(entries), 10_000):
            yield _batch(entries[i : i + 10_000])

    return fold


def content_keys(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", normalised: Column | None = None) -> DataFrame:
    """``doc_id, digest, bytes`` of each row; ``normalised`` may be any column, by default the text with null as empty."""
    content = F.coalesce(F.col(text).cast("string"), F.lit("")) if normalised is None else normalised
    return docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(content, 256)).alias("digest"), F.octet_length(content).cast("long").alias("bytes"))


def buckets_for(rows: int, spark, rows_a_bucket: int = 400_000) -> int:
    """As many buckets as keep each one's index in a task's memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_a_bucket))


def build_index(keys: DataFrame) -> DataFrame:
    """One row for each live digest: ``digest, bytes, keep_id, n``, dealt by digest."""
    one = keys.select("digest", "bytes", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    folded = one.mapInArrow(lean(_fold(SPLIT_DIGESTS)), GROUPS)
    buckets = buckets_for(keys.count(), keys.sparkSession)
    return folded.repartition(buckets, "digest").mapInArrow(lean(_fold(None)), GROUPS)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, gone = CuckooIndex(), []
    for batch in batches:
        for digest, length, keep_id, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if n < 0:
                gone.append((digest, length))
            else:
                index.add(digest, length, keep_id, n)
    for digest, length in gone:
        index.remove(digest, length)
    entries = list(index)
    for i in range(0, len(entries), 10_000):
        yield _batch(entries[i : i + 10_000])


def update_index(index: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """The index after the keys ``inserted`` and then without the digests ``deleted``; one that isn't live is ignored."""
    new = build_index(inserted)
    gone = deleted.select("digest", "bytes", F.lit(None).cast("long").alias("keep_id"), F.lit(-1).cast("long").alias("n")).distinct()
    rows = index.select("digest", "bytes", "keep_id", "n").unionByName(new).unionByName(gone)
    buckets = buckets_for(index.count(), index.sparkSession)
    return rows.repartition(buckets, "digest").mapInArrow(_apply, GROUPS)


def verified(groups: DataFrame, contents: DataFrame) -> DataFrame:
    """``groups`` whose texts are equal; two texts with one digest stop the job.

    ``contents`` has digest and content of all rows.  Those of single rows are left out by a broadcast of the repeated
    digests if these are few, and else by a join.
    """
    repeated = groups.filter("n > 1").select("digest")
    few = repeated.count() <= SMALL_ROWS
    candidates = contents.join(F.broadcast(repeated) if few else repeated, "digest", "left_semi")
    equal = candidates.groupBy("digest").agg(F.min("content").alias("low"), F.max("content").alias("high")).select("digest", (F.col("low") == F.col("high")).alias("equal"))
    checked = groups.join(equal, "digest", "left")
    return checked.withColumn("keep_id", F.when(F.coalesce("equal", F.lit(True)), F.col("keep_id")).otherwise(F.raise_error(F.lit("two texts have one digest")).cast("long"))).drop("equal")


def find_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", normalised: Column | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Null counts as empty, and all empty texts are one group.  Texts of any length are compared whole, by digest, length
    and content.  Of equal texts the largest id stays; repeated rows with one id are copies that all count, and all of them
    are ``kept`` if that id stays.  A null id yields to any other.  An empty table gives no rows; other columns are not
    read, so their names can't clash.  A digest that many rows share is met by a broadcast, so that they stay where they are.
    """
    keys = keep(content_keys(docs, text, doc_id, normalised), "keys")
    content = F.coalesce(F.col(text).cast("string"), F.lit("")) if normalised is None else normalised
    contents = docs.select(F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("content"))
    repeated = keep(build_index(keys).filter("n > 1"), "index")
    groups = keep(verified(repeated, contents).select("digest", F.col("keep_id").alias("_keep"), "n"), "groups")
    out = meet(keys, groups, ["digest"], "n", "left")  # what is in no group is a single row
    out = out.select("doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), "digest")
    return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return find_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
