"""Language identification with bit-sliced Bloom filters of byte n-grams.

Fitting finds, for each language, the n-grams that are typical of it: those whose share in the language is at least
``keep_share`` of the largest share that any language gives them.  An n-gram's Bloom slots hold one bit for each
language, so that the AND of its slots is the set of all languages that have it.  Prediction adds the bits up for each
language over a whole text, takes out the hits that a filter of that fill gives by chance, and picks the largest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import blobs, lean, padded, small_batches, steps, trim

UNKNOWN = "und"
#: n-gram lengths in bytes of folded text.
LENGTHS = (3, 4)
PAD = b" " * max(LENGTHS)
PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
FOLD = np.full(256, 32, np.uint8)
FOLD[ord("A") : ord("Z") + 1] = FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[128:] = np.arange(128, 256)
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class LanguageModel:
    """``slots[s]`` has bit ``l % width`` of word ``l // width`` set if slot ``s`` of language ``l`` is set."""

    languages: tuple[str, ...]
    slots: np.ndarray  # one row of unsigned words for each slot
    false_positive: np.ndarray  # for each language, the chance that an absent n-gram hits


def grams(buffer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: codes of the n-grams and where they begin.  Only those whose second byte is in a word count."""
    word = buffer != 32
    for n in LENGTHS:
        count = len(buffer) - n + 1
        at = np.flatnonzero(word[1 : count + 1])
        code = np.full(len(at), n, np.uint64)
        for i in range(n):
            code = (code << np.uint64(8)) | buffer[at + i].astype(np.uint64)
        yield code, at


def slot_numbers(code: np.ndarray, bits: int) -> list[np.ndarray]:
    mixed = code ^ (code >> np.uint64(15))
    return [((mixed * np.uint64(p)) >> np.uint64(64 - bits)).astype(np.int64) for p in PROBES]


def held_out(doc_id: Column) -> Column:
    """True for ids whose crc32 as text leaves 1 when divided by 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, langs = blobs(batch["text"]), np.array(batch["lang"].to_pylist(), object)
        for lang in sorted(set(langs)):
            own = [parts[i] for i in np.flatnonzero(langs == lang)]
            for lo, hi in steps([len(p) for p in own]):
                buffer, _, _ = padded(own[lo:hi], PAD)
                code, n = np.unique(np.concatenate([c for c, _ in grams(FOLD[buffer])]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_docs: int = 3000, min_count: int = 3, keep_share: float = 0.6, bits: int = 20) -> LanguageModel:
    """Learn a model from the rows that have a language and are not held out.

    A classifier may be fitted on a bounded sample: about ``max_docs`` whole documents of each language, chosen by a
    hash of the id.  All their typical n-grams that occur ``min_count`` times in the sample are learned; the filters have
    2 ** ``bits`` slots, or more if the fullest would have over half of them set.  Rows without a language or text teach
    nothing.  No rows to learn from give a model without languages, which calls every text unknown.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(counts, key=lambda x: (-counts[x], x))
    width = 8 if len(names) <= 8 else 64
    empty = lambda n: np.zeros((1 << n, max(1, -(-len(names) // width))), np.uint8 if width == 8 else np.uint64)
    if not names:
        return LanguageModel((), empty(bits), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in names for x in (k, max_docs / counts[k])])
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003).select("text", "lang")
    per = sample.mapInArrow(lean(_count_grams), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in per.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return LanguageModel((), empty(bits), np.zeros(0))
    index = {k: i for i, k in enumerate(names)}
    total = F.create_map(*[F.lit(x) for k in totals for x in (k, float(totals[k]))])
    number = F.create_map(*[F.lit(x) for k in index for x in (k, index[k])])
    typical = (
        per.withColumn("share", F.col("n") / total[F.col("lang")])
        .groupBy("gram")
        .agg(F.sum("n").alias("n"), F.max("share").alias("top"), F.collect_list(F.struct(number[F.col("lang")].alias("l"), "share")).alias("each"))
        .filter(F.col("n") >= min_count)
        .select("gram", F.transform(F.filter("each", lambda x: x["share"] >= keep_share * F.col("top")), lambda x: x["l"]).alias("langs"))
        .filter(F.size("langs") < max(2, len(names)))
        .toArrow()  # n-grams of the sample
    )
    codes = typical["gram"].to_numpy().astype(np.uint64)
    lists = typical["langs"].combine_chunks()
    row, which = np.repeat(np.arange(len(codes)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    fullest = int(np.bincount(which, minlength=1).max()) * len(PROBES)
    while 2 * fullest > 1 << bits:
        bits += 1
    slots = empty(bits)
    for slot in slot_numbers(codes[row], bits):
        np.bitwise_or.at(slots, (slot, which // width), np.left_shift(slots.dtype.type(1), (which % width).astype(slots.dtype)))
    fill = np.array([np.mean((slots[:, i // width] >> slots.dtype.type(i % width)) & slots.dtype.type(1)) for i in range(len(names))])
    return LanguageModel(tuple(names), slots, fill ** len(PROBES))


def classify(parts: list[bytes], model: LanguageModel) -> tuple[list[str], list[float]]:
    """Language and score of each text.  Each text is judged alone, so that batches do not matter."""
    n_lang, bits = len(model.languages), int(len(model.slots)).bit_length() - 1
    width = model.slots.dtype.itemsize * 8
    hits, seen, letters = np.zeros((len(parts), n_lang)), np.zeros(len(parts)), np.zeros(len(parts), bool)
    for lo, hi in steps([len(p) for p in parts], 1 << 19):
        buffer, starts, _ = padded(parts[lo:hi], PAD)
        folded = FOLD[buffer]
        edges = np.append(starts - len(PAD), len(folded))
        letters[lo:hi] = np.add.reduceat((folded >= ord("a")) & (folded <= ord("z")), edges[:-1], dtype=np.int64) > 0
        for code, at in grams(folded):
            cut = np.searchsorted(at, edges)
            seen[lo:hi] += np.diff(cut)
            mask = None
            for slot in slot_numbers(code, bits):
                mask = model.slots[slot] if mask is None else mask & model.slots[slot]
            for i in range(n_lang if len(at) else 0):
                bit = (mask[:, i // width] >> mask.dtype.type(i % width)) & mask.dtype.type(1)
                sums = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
                hits[lo:hi, i] += np.diff(sums[cut])
    rate = hits / np.maximum(seen, 1)[:, None]
    rate = np.clip((rate - model.false_positive) / np.maximum(1 - model.false_positive, 1e-9), 0, None)
    total = rate.sum(axis=1)
    best = rate.argmax(axis=1) if n_lang else np.zeros(len(parts), np.int64)
    lang, score = [], []
    for i, part in enumerate(parts):
        if not n_lang or not (letters[i] or LETTER.search(part.decode("utf-8", "replace"))):
            lang.append(UNKNOWN)
            score.append(0.0)
        else:
            lang.append(model.languages[best[i]])
            score.append(float(rate[i, best[i]] / total[i]) if total[i] > 0 else 0.0)
    return lang, score


def predictor(docs: DataFrame, model: LanguageModel):
    """A column function text -> struct(lang_pred, score) for use on frames of this session."""
    small_batches(docs.sparkSession)
    # Bounded: 2 ** bits slots, whatever the corpus.  Plain values, as executors need no copy of this package.
    shipped = docs.sparkSession.sparkContext.broadcast((model.languages, model.slots, model.false_positive))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def judge(texts: pa.Array) -> pa.Array:
        lang, score = classify(blobs(texts), LanguageModel(*shipped.value))
        trim()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return judge


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    Null and empty texts and texts without a letter get ``und`` with score 0; so does everything if the model has
    learned no language.  Of equal rates the more frequent language wins.  A text whose n-grams are all unknown gets the
    most frequent language with score 0.  Repeated rows are judged each on its own; other columns are not read.
    """
    judge = predictor(docs, model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), judge("text").alias("_r")).select("doc_id", "held_out", "_r.lang_pred", "_r.score")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, fit(docs))
