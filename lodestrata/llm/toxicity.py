"""Toxic passages as maximum-scoring segments of token log-odds.

Fitting compares how often labelled toxic and clean texts use a token: log-odds with a Dirichlet prior in proportion to
the token's use in all of them (Monroe and others, 2008).  Tokens are words and their beginnings of 3 to 8 characters, as
inflected forms share a stem and most forms are rare or new.  A token's log-odds are drawn by two standard deviations
towards those of the longest beginning in front of it, the shortest ones' towards 0, so that rare tokens say what their
stem says.  A word's log-odds are those of its longest known token.  Less a small drift, which makes the mean score of
clean text negative, these are the word scores.

A linear scan (Ruzzo and Tompa, 1999) then finds every maximal segment of a text.  The best segments of clean text follow
an extreme-value law (Karlin and Altschul, 1990): in n clean words, K * n * exp(-lambda * S) segments of a score of S or
more are expected.  lambda solves sum(p * exp(lambda * s)) = 1 over the clean words, K is fitted to the best segments of
the clean texts.  Segments of which at most ``SIGNIFICANT`` are expected are toxic passages; the sum of lambda * S - ln(K
* n) over them is the text's evidence, and a logistic curve makes it a score between 0 and 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resampling import Ragged, _spread, crc32s
from .shared import blobs, keep, lean, meet, small_batches, steps, trim
from .words import Words, binary_array, split_words

#: What each word takes off a segment's score; segments of which so many are expected in a clean text are passages.
DRIFT, SIGNIFICANT = 0.05, 0.05
#: Tokens of the prior, over all tokens; standard deviations by which log-odds are drawn to those in front.
PRIOR_TOKENS, DEVIATIONS = 1000.0, 2.0
#: Characters of the beginnings that are tokens beside the whole words.
STEMS = range(3, 9)
#: Words of a run whose least hash is a text's sketch; the weight of a whole text.
RUN, WHOLE = 5, 1 << 20
STEP = 1 << 20
#: Evidence beyond it says no more.
MOST_EVIDENCE = 50.0


class ToxicModel(NamedTuple):
    sizes: np.ndarray  # characters of each token that is a beginning, 0 for whole words
    tokens: tuple[bytes, ...]  # those that don't score as what is in front of them
    scores: np.ndarray
    neutral: float  # the score of a word without a known token
    rate: float  # lambda
    k: float
    intercept: float
    slope: float


def held_out(doc_id: Column) -> Column:
    """True for ids whose crc32 as text leaves 2 when divided by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def maximal_segments(scores: list[float]) -> list[tuple[int, int]]:
    """Begin and end of every maximal-scoring segment, in order: no overlap, and each one's ends can't be moved for more.

    Every candidate keeps the sum before it, the sum at its end, and the last candidate before it with a lesser sum in
    front; those between needn't be looked at again, so that the work is linear.
    """
    low, high, begin, end, back = [], [], [], [], []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, now = i, before
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= now:
                j = back[j]
            if j < 0 or high[j] >= total:
                break
            first, now = begin[j], low[j]
            for of in (low, high, begin, end, back):
                del of[j:]
        low.append(now)
        high.append(total)
        begin.append(first)
        end.append(i + 1)
        back.append(j)
    return list(zip(begin, end, strict=True))


def segments(words: Words, scores: np.ndarray) -> list[list[tuple[int, int, float]]]:
    """For each text the maximal segments as first word, word behind the last, and score.

    Segments begin and end with tokens of a positive score, so runs of tokens of one sign are scanned as one.
    """
    sums = np.append(0.0, np.cumsum(scores))
    out = []
    for lo, hi in zip(words.cuts[:-1].tolist(), words.cuts[1:].tolist(), strict=True):
        own = scores[lo:hi] > 0
        if not own.any():
            out.append([])
            continue
        edges = lo + np.append(0, np.append(np.flatnonzero(np.diff(own)) + 1, hi - lo))
        at = sums[edges] - sums[lo]
        found = maximal_segments(np.diff(at).tolist())
        out.append([(int(edges[b]), int(edges[e]), float(at[e] - at[b])) for b, e in found])
    return out


def beginnings(words: pa.Array, size: int) -> pa.Array:
    """The first ``size`` characters of each word (a large binary without nulls), null for shorter ones."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    first = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
    at = np.searchsorted(first, offsets)
    long = np.diff(at) >= size
    behind = np.append(first, len(data))[np.minimum(at[:-1] + size, len(first))]
    length = np.where(long, np.minimum(behind, offsets[1:]) - offsets[:-1], 0)
    cut = binary_array(data[_spread(offsets[:-1], length)], np.append(0, np.cumsum(length)))
    return pc.if_else(pa.array(long), cut, pa.scalar(None, pa.large_binary()))


class Tokens:
    """Known tokens by size, whole words last, to be found for many words at once."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, pa.Array, int]] = []
        self.n = 0

    def add(self, size: int, tokens: pa.Array) -> None:
        if len(tokens):
            self.levels.append((size, tokens, self.n))
            self.n += len(tokens)

    def longest(self, words: pa.Array) -> np.ndarray:
        """The number of each word's longest known token, counted as they were added; ``n`` where none is known."""
        out = np.full(len(words), self.n)
        for size, tokens, begin in self.levels:
            found = pc.fill_null(pc.index_in(beginnings(words, size) if size else words, tokens, skip_nulls=True), -1).to_numpy().astype(np.int64)
            out = np.where(found >= 0, begin + found, out)
        return out


def known_tokens(model: ToxicModel) -> Tokens:
    out, tokens = Tokens(), pa.array(model.tokens, pa.large_binary())
    for size in (*STEMS, 0):
        out.add(size, tokens.filter(pa.array(model.sizes == size)))
    return out


def token_scores(words: Words, tokens: Tokens, scores: np.ndarray) -> np.ndarray:
    """The score of each word; ``scores`` has those of the tokens and then that of words without one."""
    encoded = words.array().dictionary_encode()
    return scores[tokens.longest(encoded.dictionary)][encoded.indices.to_numpy()]


def _sketches(words: Words) -> np.ndarray:
    """The least hash of each text's runs of ``RUN`` words: mostly equal for near copies.  Shorter texts have 0."""
    encoded = words.array().dictionary_encode()
    firsts = np.unique(encoded.indices.to_numpy(), return_index=True)[1]
    begin = words.offsets[firsts]
    own = crc32s(Ragged(words.data, begin, words.offsets[firsts + 1] - begin)).astype(np.uint64)[encoded.indices.to_numpy()]
    n = max(0, len(own) - RUN + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(RUN):
        mixed = (mixed ^ own[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    out = np.zeros(len(words.cuts) - 1, np.uint64)
    for i, (lo, hi) in enumerate(zip(words.cuts[:-1].tolist(), words.cuts[1:].tolist(), strict=True)):
        if hi - lo >= RUN:
            out[i] = mixed[lo : hi - RUN + 1].min()
    return out.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = blobs(batch["text"])
        sketches = [_sketches(split_words(parts[lo:hi])) for lo, hi in steps([len(p) for p in parts])]
        yield pa.RecordBatch.from_arrays([batch["text"], batch["toxic"], pa.array(np.concatenate(sketches) if sketches else np.zeros(0, np.int64))], ["text", "toxic", "sketch"])


def _count(codes: np.ndarray, texts: np.ndarray, n: int, toxic: np.ndarray, weight: np.ndarray) -> list[pa.Array]:
    """For each of ``n`` codes the clean and the toxic texts that hold it, a text counting as its weight; codes below 0 don't count."""
    pairs = np.unique(codes[codes >= 0] * len(toxic) + texts[codes >= 0])
    code, text = np.divmod(pairs, max(1, len(toxic)))
    return [pa.array(np.bincount(code, weight[text] * (toxic[text] == t), n).astype(np.int64)) for t in (False, True)]


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each token and class the weight of the texts that hold it."""
    for batch in batches:
        toxic, weight = batch["toxic"].to_numpy(zero_copy_only=False), batch["weight"].to_numpy()
        parts = blobs(batch["text"])
        for lo, hi in steps([len(p) for p in parts], STEP):
            words = split_words(parts[lo:hi])
            encoded, texts = words.array().dictionary_encode(), words.text_of()
            for size in (*STEMS, 0):
                of = (beginnings(encoded.dictionary, size) if size else encoded.dictionary).dictionary_encode()
                codes = pc.fill_null(of.indices, -1).to_numpy().astype(np.int64)[encoded.indices.to_numpy()]
                counts = _count(codes, texts, len(of.dictionary), toxic[lo:hi], weight[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(of.dictionary), size, np.int32)), of.dictionary.cast(pa.binary()), *counts], ["size", "token", "clean", "toxic"])


def _count_longest(model: ToxicModel):
    """A batch function: for each known token, by number, and class the weight of texts with the words it is the longest of."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = known_tokens(model)
        for batch in batches:
            toxic, weight = batch["toxic"].to_numpy(zero_copy_only=False), batch["weight"].to_numpy()
            parts = blobs(batch["text"])
            for lo, hi in steps([len(p) for p in parts], STEP):
                words = split_words(parts[lo:hi])
                encoded, texts = words.array().dictionary_encode(), words.text_of()
                counts = _count(encoded.indices.to_numpy().astype(np.int64), texts, len(encoded.dictionary), toxic[lo:hi], weight[lo:hi])
                numbers = tokens.longest(encoded.dictionary)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *counts], ["number", "clean", "toxic"])

    return count


def log_odds(clean: np.ndarray, toxic: np.ndarray, front: np.ndarray | float = 0.0) -> np.ndarray:
    """Log-odds of each token, drawn to those in front of it by some of their standard deviations."""
    n_clean, n_toxic = clean.sum(), toxic.sum()
    prior = PRIOR_TOKENS * (clean + toxic) / max(1.0, n_clean + n_toxic)
    a, b = toxic + prior, clean + prior
    rest_a, rest_b = (np.maximum(0.5, n + PRIOR_TOKENS - x) for n, x in ((n_toxic, a), (n_clean, b)))  # none if there is one token
    odds = np.log(a / rest_a) - np.log(b / rest_b) - front
    return front + np.sign(odds) * np.maximum(0.0, np.abs(odds) - DEVIATIONS * np.sqrt(1 / a + 1 / b))


def _rate(share: np.ndarray, scores: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * score)) = 1; share sums to 1 and the mean score is negative."""
    value = lambda x: float(np.sum(share * np.exp(np.minimum(x * scores, 700.0)))) - 1
    high = 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    low = 0.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a slight ridge that keeps separable classes finite.

    A step that would raise the loss is halved: whole ones circle where most rows are far from the boundary.
    """
    design, beta = np.stack([np.ones(len(x)), x], axis=1), np.zeros(2)
    ridge = np.diag([1e-6, 1e-2])
    loss = lambda beta: float(weight @ (np.logaddexp(0, design @ beta) - y * (design @ beta)) + beta @ ridge @ beta / 2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        down = design.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge, down)
        now = loss(beta)
        while loss(beta + step) > now - 1e-4 * (down @ step) and np.abs(step).max() > 1e-9:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        beta = beta + step
    return float(beta[0]), float(max(beta[1], 0.0))


def evidence(model: ToxicModel, n: int, found: list[tuple[int, int, float]]) -> tuple[float, list[float]]:
    """A text's evidence and each segment's expected number in as many clean tokens."""
    if not found:
        return -MOST_EVIDENCE, []
    base = math.log(model.k * max(n, 1))
    bits = [model.rate * s - base for _, _, s in found]
    passages = [b for b in bits if b >= -math.log(SIGNIFICANT)]
    return max(-MOST_EVIDENCE, min(sum(passages) if passages else max(bits), MOST_EVIDENCE)), [math.exp(min(-b, 700.0)) for b in bits]


def _squash(x: float) -> float:
    return math.asinh(x)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", label_id: str = "doc_id", max_docs: int = 20_000, min_count: int = 5) -> ToxicModel:
    """Learn a model from the labelled rows that are not held out.

    A classifier may be fitted on a bounded sample: about ``max_docs`` whole documents of each class, chosen by a hash of
    the id; of equal texts of one class one counts.  Tokens of ``min_count`` texts are learned; a text counts once for a
    token, and less if others of its class have its sketch.  Of several
    labels of an id the largest counts; null labels and ids teach nothing.  If a class is missing, the model knows no token
    and scores every text with the share of toxic labels.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.select(F.col(label_id).alias("id"), F.col(label).cast("int").alias("toxic")).filter("id is not null and toxic is not null").filter(~held_out(F.col("id")))
    known = keep(known.groupBy("id").agg((F.max("toxic") > 0).alias("toxic")), "labels")
    clean, toxic = known.agg(F.count(F.when(~F.col("toxic"), 1)), F.count(F.when(F.col("toxic"), 1))).first()
    share = F.when(F.col("toxic"), max_docs / max(1, toxic)).otherwise(max_docs / max(1, clean))
    ids = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < share * 1_000_003)  # about 2 * max_docs rows
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), "id").select("text", "toxic")
    # Near copies would make their own words telling: texts of one sketch count as one.
    sketched = keep(rows.dropDuplicates(["text", "toxic"]).mapInArrow(lean(_sketch), "text string, toxic boolean, sketch long"), "sketches")
    groups = sketched.groupBy("sketch", "toxic").agg(F.count("*").alias("n"))
    sample = keep(meet(sketched, groups, ["sketch", "toxic"], "n").select("text", "toxic", F.when(F.col("sketch") == 0, WHOLE).otherwise(F.floor(F.lit(WHOLE) / F.col("n"))).alias("weight")), "sample")
    counted = sample.mapInArrow(lean(_count_tokens), "size int, token binary, clean long, toxic long").groupBy("size", "token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counted.filter(F.col("clean") + F.col("toxic") >= min_count * WHOLE).toArrow().sort_by([("size", "ascending"), ("token", "ascending")])  # tokens of the sample
    if not pc.sum(counts["clean"]).as_py() or not pc.sum(counts["toxic"]).as_py():
        return ToxicModel(np.zeros(0, int), (), np.zeros(0), -DRIFT, 1.0, 1.0, math.log((toxic + 1e-6) / (clean + 1e-6)), 0.0)
    tokens, odds, sizes, names = Tokens(), np.zeros(0), [], []
    for size in (*STEMS, 0):  # a token's beginnings are in at least as many texts, so they were counted, too
        own = counts.filter(pc.equal(counts["size"], size))
        name = own["token"].cast(pa.large_binary()).combine_chunks()
        front = np.append(odds, 0.0)[tokens.longest(name)]
        drawn = log_odds(*(own[c].to_numpy() / WHOLE for c in ("clean", "toxic")), front)
        telling = np.abs(drawn - front) > 1e-12
        tokens.add(size, name.filter(pa.array(telling)))
        odds = np.append(odds, drawn[telling])
        sizes += [size] * int(telling.sum())
        names += name.filter(pa.array(telling)).to_pylist()
    model = ToxicModel(np.array(sizes, int), tuple(names), odds, 0.0, 1.0, 1.0, 0.0, 0.0)
    used = sample.mapInArrow(lean(_count_longest(model)), "number long, clean long, toxic long").groupBy("number").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    n_clean, n_toxic = (np.bincount(used["number"].to_numpy(), used[c].to_numpy() / WHOLE, len(odds) + 1) for c in ("clean", "toxic"))
    scores = np.append(odds, 0.0) - DRIFT
    prior = PRIOR_TOKENS * (n_clean + n_toxic) / (n_clean + n_toxic).sum()
    share = (n_clean + prior) / (n_clean + prior).sum()
    scores = scores - max(0.0, float(np.sum(share * scores)) + DRIFT / 2)
    rate = _rate(share, scores)
    model = model._replace(scores=scores[:-1], neutral=float(scores[-1]), rate=rate)
    best = sample.select("toxic", finder(spark, model, math.inf)("text").alias("f")).select("toxic", "f.n_tokens", "f.passages")
    top = F.coalesce(F.array_max(F.transform("passages", lambda p: p["score"])), F.lit(0.0))
    n, expected = best.filter("not toxic").agg(F.count("*"), F.sum(F.col("n_tokens") * F.exp(-rate * top))).first()
    model = model._replace(k=n / expected if expected else 1.0)
    graded = sample.select("toxic", finder(spark, model)("text").alias("f")).groupBy("toxic", F.round("f.evidence", 1).alias("x")).count().toArrow()  # at most 1000 values a class
    x = np.array([_squash(v) for v in graded["x"].to_pylist()])
    y, weight = graded["toxic"].to_numpy(zero_copy_only=False).astype(float), graded["count"].to_numpy().astype(float)
    # The classes were drawn with chances of their own; each weighs as much as it does among the labels.
    drawn = np.array([max(1.0, weight[y == c].sum()) for c in (0, 1)])
    weight = weight * (np.array([clean, toxic]) / drawn)[y.astype(int)]
    intercept, slope = _logistic(x, y, weight)
    return model._replace(intercept=intercept, slope=slope)


def finder(spark, model: ToxicModel, most: float = SIGNIFICANT):
    """A column function text -> struct(n_tokens, evidence, score, passages) for use on frames of this session.

    Passages are the segments of which at most ``most`` are expected.
    A passage has its place in the text (characters, end exclusive), its score and the number of such ones expected by chance.
    """
    small_batches(spark)
    shipped = spark.sparkContext.broadcast((tuple(model), most))  # the tokens of a bounded sample

    @F.arrow_udf("struct<n_tokens: long, evidence: double, score: double, passages: array<struct<begin: long, end: long, score: double, expected: double>>>")
    def find(texts: pa.Array) -> pa.Array:
        values, most = shipped.value
        model = ToxicModel(*values)
        tokens, by_token, parts = known_tokens(model), np.append(model.scores, model.neutral), blobs(texts)
        sizes, grades, scores, ends = [], [], [], [0]
        begin, end, score, expected = [], [], [], []
        for lo, hi in steps([len(p) for p in parts], STEP):
            words = split_words(parts[lo:hi])
            for i, found in enumerate(segments(words, token_scores(words, tokens, by_token))):
                n = int(words.cuts[i + 1] - words.cuts[i])
                grade, chance = evidence(model, n, found)
                passages = [(first, last, s, e) for (first, last, s), e in zip(found, chance, strict=True) if e <= most]
                if passages:
                    characters = np.append(0, np.cumsum((np.frombuffer(parts[lo + i], np.uint8) & 0xC0) != 0x80))
                    first, last, s, e = zip(*passages, strict=True)
                    begin += characters[words.begins[list(first)]].tolist()
                    end += characters[words.ends[[x - 1 for x in last]]].tolist()
                    score += s
                    expected += e
                sizes.append(n)
                grades.append(grade)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, model.intercept + model.slope * _squash(grade))))))
                ends.append(len(begin))
        trim()
        passages = pa.StructArray.from_arrays([pa.array(begin, pa.int64()), pa.array(end, pa.int64()), pa.array(score, pa.float64()), pa.array(expected, pa.float64())], ["begin", "end", "score", "expected"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), passages)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(grades, pa.float64()), pa.array(scores, pa.float64()), lists], ["n_tokens", "evidence", "score", "passages"])

    return find


def toxic_passages(docs: DataFrame, model: ToxicModel, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` for every row.

    Null and empty texts and texts without a known token have the least evidence, no passage and about the score of a
    clean text.  Texts of any length are scanned whole; repeated rows are judged each on its own; a null id counts as empty
    text for ``held_out``.  An empty table gives no rows.  Other columns are not read, so their names can't clash.
    """
    find = finder(docs.sparkSession, model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), find(F.col(text).cast("string")).alias("f"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("f.score").alias("score"), (F.col("f.score") >= threshold).cast("int").alias("predicted"), F.col("f.passages").alias("passages"))


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = toxic_passages(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))
