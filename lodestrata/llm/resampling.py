"""Importance resampling towards a target: documents drawn with chances that rise with how target-like their words are.

A document's features are its runs of one to ``longest`` words.  Hashed into buckets, they are counted over all documents
and over the target; the log ratio of a bucket's two shares is its gain, and the floored mean of a document's gains its
weight.  The weight plus Gumbel noise from the document's id is its score, so that the documents of the highest scores
are a draw without replacement in proportion to exp(weight / 1000).

A bucket is the CRC-32 of the feature's bytes, for all distinct features of a step at once: features of equal length are
the rows of a matrix of bytes, and one pass over its columns updates all their CRCs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import blobs, keep, lean, local_rows, small_batches, steps, trim
from .words import Words, split_words

#: Features up to this length share a matrix with those of just their length.
EXACT = 64
#: Cells of a matrix, but for a longer row.
CELLS = 8 << 20
#: Rows that a task sorts.
RANGE_ROWS = 4_000_000
#: The bits of a row's place in its partition in ``monotonically_increasing_id``.
POSITION = (1 << 33) - 1


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte: eight steps of division by the reversed polynomial."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (value & np.uint32(1)))
    return value


TABLE = _crc_table()


class Ragged(NamedTuple):
    """Byte strings: the bytes ``begin[i]`` to ``begin[i] + length[i]`` of ``data``."""

    data: np.ndarray
    begin: np.ndarray
    length: np.ndarray


def _spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions begin[i], ..., begin[i] + length[i] - 1, one string after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - length), length)


def joined(left: Ragged, right: Ragged) -> Ragged:
    """Each left string, a space, and the right string of the same number."""
    length = left.length + 1 + right.length
    begin = np.cumsum(length) - length
    data = np.full(int(length.sum()), 32, np.uint8)
    data[_spread(begin, left.length)] = left.data[_spread(left.begin, left.length)]
    data[_spread(begin + left.length + 1, right.length)] = right.data[_spread(right.begin, right.length)]
    return Ragged(data, begin, length)


def crc32s(strings: Ragged) -> np.ndarray:
    """CRC-32 of each string, by matrices of strings of equal length.

    Strings of over ``EXACT`` bytes have so many lengths that those of about one length share a matrix, right-aligned:
    with a register of 0, zeros in front change nothing, and the usual start of all ones is the complement of a
    string's first four bytes.
    """
    data, begin, length = strings
    step = np.ceil(np.log(np.maximum(length, EXACT) / EXACT) / math.log(1.25))
    width = np.where(length <= EXACT, length, np.ceil(EXACT * 1.25**step).astype(np.int64))
    out = np.empty(len(length), np.uint32)
    order = np.argsort(width, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(width[order])) + 1) if len(order) else []:
        w = int(width[group[0]])
        most = max(1, CELLS // max(1, w))
        for lo in range(0, len(group), most):
            rows = group[lo : lo + most]
            out[rows] = _by_column(data, begin[rows], length[rows], w)
    return out


def _by_column(data: np.ndarray, begin: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    if width <= EXACT:
        matrix = data[begin + np.arange(width)[:, None]]
        crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    else:
        pad = width - length
        matrix = np.zeros((width, len(begin)), np.uint8)
        for i, (b, n, p) in enumerate(zip(begin.tolist(), length.tolist(), pad.tolist(), strict=True)):
            matrix[p:, i] = data[b : b + n]
            matrix[p : p + 4, i] ^= 0xFF
        crc = np.zeros(len(begin), np.uint32)
    for column in matrix:
        crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def features(words: Words, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each run of one to ``longest`` words of a text; each distinct run is hashed once."""
    text = words.text_of()
    encoded = words.array().dictionary_encode()
    ids = encoded.indices.to_numpy().astype(np.int64)
    firsts = np.zeros(len(encoded.dictionary), np.int64)
    firsts[ids[::-1]] = np.arange(len(ids))[::-1]
    word = Ragged(words.data, words.offsets[firsts], words.offsets[firsts + 1] - words.offsets[firsts])
    run, runs, at = ids, word, np.arange(len(ids))  # the runs of n words: their numbers, distinct bytes and beginnings
    found, owner = [], []
    for n in range(1, longest + 1):
        if n > 1:  # a run of n words is one of n - 1 and the word behind it, in the same text
            more = np.flatnonzero(at + n - 1 < len(ids))
            more = more[text[at[more]] == text[at[more] + n - 1]]
            at = at[more]
            run, pairs = pd.factorize(run[more] * len(firsts) + ids[at + n - 1])
            left, right = pairs // len(firsts), pairs % len(firsts)
            runs = joined(Ragged(runs.data, runs.begin[left], runs.length[left]), Ragged(word.data, word.begin[right], word.length[right]))
        found.append((crc32s(runs) % np.uint32(buckets)).astype(np.int64)[run])
        owner.append(text[at])
    return np.concatenate(found), np.concatenate(owner)


def _count(longest: int, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            parts = blobs(batch["text"])
            for lo, hi in steps([len(p) for p in parts]):
                bucket, _ = features(split_words(parts[lo:hi]), longest, buckets)
                total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    return lean(count)


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How many features fall into each bucket, over all rows; each split adds up its own before the shuffle."""
    small_batches(docs.sparkSession)
    counted = docs.select(F.col(text).alias("text")).mapInArrow(_count(longest, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # one row for each bucket
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of a bucket's share of the target over its share of the raw documents, each with one more; floored."""
    s, t, n = float(raw.sum()), float(target.sum()), float(len(raw))
    pairs = zip(raw.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in pairs], np.int64)


def weigher(docs: DataFrame, gain: np.ndarray, longest: int):
    """A column function text -> struct(n_words, n_features, weight)."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def weigh(texts: pa.Array) -> pa.Array:
        parts, gain = blobs(texts), shipped.value
        n_words, n_features, weight = (np.zeros(len(parts), np.int64) for _ in range(3))
        for lo, hi in steps([len(p) for p in parts]):
            words = split_words(parts[lo:hi])
            bucket, owner = features(words, longest, len(gain))
            n = np.bincount(owner, minlength=hi - lo)
            order = np.argsort(owner, kind="stable")
            sums = np.append(0, np.cumsum(gain[bucket[order]]))
            ends = np.cumsum(n)
            total = sums[ends] - sums[ends - n]
            n_words[lo:hi], n_features[lo:hi], weight[lo:hi] = np.diff(words.cuts), n, total // np.maximum(n, 1)
        trim()
        return pa.StructArray.from_arrays([pa.array(n_words), pa.array(n_features), pa.array(weight)], ["n_words", "n_features", "weight"])

    return weigh


def ranked(rows: DataFrame, count: int, order: list, most: int) -> DataFrame:
    """The ``count`` ``rows`` with ``rank``: 1, 2, 3... in ``order`` up to ``most``, then null.  Reads ``rows`` twice: keep them before.

    Ranges of the order are sorted each on its own, and a row's rank is its place in its range and the number of rows in
    the ranges before.  Rows that are equal in ``order`` may part at any of them, so that no range outgrows the others:
    their place in what is read decides.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // RANGE_ROWS))
    ranges = numbered.repartitionByRange(parts, *order, F.col("_row")).sortWithinPartitions(*order, F.col("_row")).drop("_row")
    placed = keep(ranges.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # one row for each range
    before, total = [], 0
    for p, n in sorted(map(tuple, sizes)):
        before.append((p, total))
        total += n
    starts = local_rows(rows.sparkSession, "part long, before long", before)
    rank = F.col("before") + F.col("_place").bitwiseAND(F.lit(POSITION)) + 1
    return placed.withColumn("part", part).join(F.broadcast(starts), "part", "left").select(*rows.columns, F.when(rank <= most, rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", longest: int = 2, buckets: int = 10_000, least_words: int = 20, percent: int = 25, seed: int = 7) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row; the drawn ones have a rank.

    Of the N rows with ``least_words`` words or more the floor(percent * N / 100) highest scores are drawn, equal scores by
    smaller id.  A null or empty text has no words, a weight of 0 and is never drawn; a null id counts as empty text in the
    noise and comes last among equals.  Repeated rows are rows each: of equal ones some may be drawn and others not.  Texts
    of any length count whole.  With an empty target all gains come from the documents alone; an empty table gives no rows.
    No other column is read, so their names can't clash.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    weigh = weigher(docs, gain, longest)
    rows = docs.select(F.col(doc_id).alias("doc_id"), weigh(F.col(text).cast("string")).alias("w")).select("doc_id", "w.*")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = keep(rows.withColumn("score", F.col("weight") + noise), "scores")
    enough = F.col("n_words") >= least_words
    n, count = scored.agg(F.count(F.when(enough, 1)), F.count("*")).first()
    order = [enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return ranked(scored, count, order, percent * n // 100).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The whole rows of ``docs`` whose ids ``resample`` draws; rows without an id aren't among them."""
    ids = resample(docs, target, doc_id=doc_id, **options).filter("rank is not null").select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(ids, doc_id, "left_semi")


def op11_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
