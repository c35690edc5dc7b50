"""Resampling, lexical search and toxicity against brute force and held-out labels."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from comparing import connect, same_rows
from lodestrata.llm import lexical_search as X
from lodestrata.llm import resampling as R
from lodestrata.llm import toxicity as T
from lodestrata.llm.words import split_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [None, "", " ", "One two ONE", "é1 É1 日本語 naïve-x", "a\x00b\tc_d`e", "word " * 40, "\U0001f600 z", "x" * 300 + " " + "y" * 71, "of the of the " * 15]


def words_of(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def test_words():
    parts = [(t or "").encode() for t in TEXTS]
    found = split_words(parts)
    each = [w.decode() for w in found.array().to_pylist()]
    assert [each[a:b] for a, b in zip(found.cuts[:-1], found.cuts[1:])] == [words_of(t) for t in TEXTS]
    text = found.text_of()
    assert all(parts[text[i]][b:e].decode().translate({i: i + 32 for i in range(65, 91)}) == each[i] for i, (b, e) in enumerate(zip(found.begins.tolist(), found.ends.tolist())))
    assert split_words([]).cuts.tolist() == [0]


def test_crcs():
    draw = random.Random(5)
    parts = [draw.randbytes(n) for n in [*range(70), 64, 65, 79, 80, 81, 100, 1000, 5000] for _ in range(3)]
    length = np.array([len(p) for p in parts])
    assert R.crc32s(R.Ragged(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(length) - length, length)).tolist() == [zlib.crc32(p) for p in parts]


def resampled(rows, target, buckets=10_000, longest=2, least=20, percent=25):
    """Row by row: n_features, weight, score of each row, and the ranks of those drawn."""
    runs = lambda t: [" ".join(w[i : i + n]) for w in [words_of(t)] for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    count = lambda texts: np.bincount([zlib.crc32(f.encode()) % buckets for t in texts for f in runs(t)], minlength=buckets) if any(runs(t) for t in texts) else np.zeros(buckets, int)
    s, t = count([x for _, x in rows]), count(target)
    big_s, big_t = int(s.sum()), int(t.sum())
    out = []
    for i, text in rows:
        own = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in (zlib.crc32(f.encode()) % buckets for f in runs(text))]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted(((-r[3], r[0] is None, r[0] or 0) for r, (_, text) in zip(out, rows, strict=True) if len(words_of(text)) >= least))
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling(spark, longest):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice(["alpha", "beta", "Gamma", "é", "of", "the"]) for _ in range(draw.randrange(60)))) for i in range(150)]
    rows += list(enumerate(TEXTS, 200)) + [(None, "nobody " * 30), (None, "nobody " * 30), (7, rows[7][1])]
    target = ["Alpha beta alpha beta of", None, "", "Of the é"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("bucket", F.lit(1))
    got = R.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest).collect()
    want, drawn = resampled(rows, target, longest=longest)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got), key=str) == sorted(want, key=str)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1)) and [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in ranked] == drawn


def test_resampling_of_equal_rows_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGE_ROWS", 500)
    text, none = "the same words " * 10, spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame([(1, text)] * 4000 + [(2, "x")], "doc_id long, text string")
    got = R.resample(docs, none)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 1001)) and got.count() == 4001
    assert R.resample(none, docs).count() == 0
    assert R.drawn(docs.limit(40).union(docs.filter("doc_id = 2")), docs).count() == 40  # rows of one id are drawn together


def test_resampling_query(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want, drawn = resampled(docs, [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()])
    got = R.op11_resampling(spark, small).collect()
    assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == sorted(want) and [f.dataType.simpleString() for f in R.op11_resampling(spark, small).schema] == ["bigint"] * 5
    assert [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == [i for *_, i in drawn]


def searched(docs, items, k=10, k1=8, b=90):
    words = [(i, words_of(t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, w in words:
            score = 0
            for x in set(words_of(text)) & set(w):
                m = 100 - b + (b * len(w) * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * w.count(x)) // (1000 * w.count(x) + k1 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("tiles", [(200_000, 64, 512, 4096), (10, 2, 3, 4)])
def test_search(spark, monkeypatch, tiles):
    """Ties at the tenth place, repeated documents and items, several groups and tiles, wide vocabularies."""
    for name, value in zip(("GROUP_TERMS", "ITEM_TILE", "DOC_TILE", "TERM_TILE"), tiles, strict=True):
        monkeypatch.setattr(X, name, value)
    draw = random.Random(8)
    vocabulary = [f"t{i}" for i in range(25)] + ["É", "日本"]
    text = lambda n: " ".join(draw.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))
    docs = [(i, text(draw.randrange(12))) for i in range(80)] + [(100 + i, "T1 t2") for i in range(30)] + [(None, "t20 t21"), (5, "t20 t21"), (5, "t20 t21"), (900, None), (901, " ... ")]
    items = [(i, text(draw.randrange(1, 9))) for i in range(9)] + [(20, "t1"), (20, "t1"), (21, None), (22, ""), (23, "unknown"), (None, "t20 T20")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item": F.lit(1), "score": F.lit("x")}).repartition(3)
    got = X.top_documents(frame, spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)))
    assert sorted(map(tuple, got.collect()), key=str) == searched(docs, items)


def test_search_of_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert X.top_documents(none, some).count() == 0
    assert X.top_documents(some.withColumnRenamed("item_id", "doc_id"), none.withColumnRenamed("doc_id", "item_id")).count() == 0
    long = spark.createDataFrame([(1, "a " * 2_000_000), (2, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in X.top_documents(long, some).collect()] == searched([(1, "a " * 2_000_000), (2, "a b")], [(1, "a b")])


def test_search_query(spark, small):
    same_rows(X.op12_lexical_search(spark, small), connect(small), X.OP12_SQL)


def segments(scores):
    """By definition: the best segment, then those left and right of it."""
    best = None
    for b in range(len(scores)):
        total = 0
        for e in range(b, len(scores)):
            total += scores[e]
            if total > 0 and (best is None or total > best[0]):
                best = total, b, e + 1
    if not best:
        return []
    _, b, e = best
    return segments(scores[:b]) + [(b, e)] + [(x + e, y + e) for x, y in segments(scores[e:])]


def test_maximal_segments():
    draw = random.Random(4)
    for _ in range(2000):
        scores = [draw.uniform(-1, 1) for _ in range(draw.randrange(15))]
        assert T.maximal_segments(scores) == segments(scores)
    words = split_words([b"a b c", b"", b"d e f g"])
    assert [[(b, e, round(s, 6)) for b, e, s in own] for own in T.segments(words, np.array([1.0, 1, -3, 2, -1, -0.5, 3]))] == [[(0, 2, 2.0)], [], [(3, 7, 3.5)]]


def labelled(spark, n=600):
    draw = random.Random(6)
    usual = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(n):
        words = draw.choices(usual, k=draw.randrange(5, 120))
        toxic = i % 6 == 0
        for _ in range(draw.randrange(2, 6) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["nasty", "Vile", "gräßlich"]))
        rows.append((i, "é " + ", ".join(words)))
        marks.append((i, int(toxic)))
    rows += [(n, None), (n + 1, ""), (None, "nasty vile"), (n + 2, "calm " * 50_000 + "nasty vile nasty"), (n + 2, "calm")]
    marks += [(n, 1), (None, 1), (3, None), (6, 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1)), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_toxicity(spark):
    rows, docs, labels = labelled(spark)
    model = T.fit(docs, labels)
    out = T.toxic_passages(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 == 2) for r in out)
    judged = [(r["predicted"], r["doc_id"] % 6 == 0) for r in out if r["held_out"] and r["doc_id"] < 600]
    assert len(judged) > 100 and sum(p == t for p, t in judged) / len(judged) > 0.97
    texts = dict(rows)
    for r in out:  # passages begin and end with whole words of the text, and hold what makes it toxic
        text = texts[r["doc_id"]] or ""
        found = [text[p["begin"] : p["end"]] for p in r["passages"] if r["doc_id"] != 602]
        assert all(p["expected"] <= T.SIGNIFICANT for p in r["passages"])
        assert all(re.fullmatch(r"\w.*\w", f) and re.search(rf"(?<!\w){re.escape(f)}(?!\w)", text) for f in found)
        if r["predicted"] and r["doc_id"] is not None and r["doc_id"] < 600 and r["doc_id"] % 6 == 0:
            assert any(w in f.lower() for f in found for w in ("nasty", "vile", "gräßlich"))
    by_id = {r["doc_id"]: r for r in out if r["doc_id"] is None or r["doc_id"] > 599}
    assert by_id[None]["predicted"] == 1 and by_id[600]["predicted"] == by_id[601]["predicted"] == 0 and by_id[600]["score"] == by_id[601]["score"]
    assert any(r["predicted"] for r in out if r["doc_id"] == 602)  # a passage in fifty thousand calm words


def test_toxicity_without_labels(spark):
    rows, docs, labels = labelled(spark, 30)
    for some in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        scores = {r["score"] for r in T.toxic_passages(docs, T.fit(docs, some)).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1
    assert T.toxic_passages(docs.limit(0), T.fit(docs.limit(0), labels)).count() == 0


def test_rate_and_extremes():
    """The rate solves its equation, and passages of clean text are about as rare as expected."""
    draw = np.random.default_rng(3)
    share, scores = np.array([0.9, 0.08, 0.02]), np.array([-0.3, 0.5, 2.0])
    rate = T._rate(share, scores)
    assert abs(np.sum(share * np.exp(rate * scores)) - 1) < 1e-9
    best = []
    for _ in range(400):
        own = scores[draw.choice(3, 500, p=share)].tolist()
        best.append(max(sum(own[b:e]) for b, e in T.maximal_segments(own)))
    k = 400 / np.sum(500 * np.exp(-rate * np.array(best)))
    for level in (0.5, 0.1):
        assert abs(np.mean(k * 500 * np.exp(-rate * np.array(best)) <= -np.log(1 - level)) - level) < 0.08


def test_toxicity_of_inflected_words(spark):
    """Toxic stems with endings of their own: no whole word comes back, and clean words begin like them."""
    draw = random.Random(8)
    usual = [f"word{i}" for i in range(200)] + ["grab", "kräftig", "kräne"]
    rows, marks = [], []
    for i in range(800):
        words = draw.choices(usual, k=draw.randrange(20, 100))
        for _ in range(draw.randrange(2, 5) if i % 5 == 0 else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["grässl", "krätz"]) + "".join(draw.choices("abcdefghi", k=7)))
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 5 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    out = [r for r in T.toxic_passages(docs, T.fit(docs, labels)).collect() if r["held_out"]]
    caught, clean = ([r["predicted"] == toxic for r in out if (r["doc_id"] % 5 == 0) == toxic] for toxic in (True, False))
    assert len(caught) > 25 and sum(caught) / len(caught) > 0.95 and sum(clean) / len(clean) > 0.95


def test_beginnings():
    words = ["", "a", "äöü", "abc", "äöüß", "日本語", "x" * 9, "a😀b😀"]
    for own in (pa.array([w.encode() for w in words], pa.large_binary()), pa.array([b"skip", *[w.encode() for w in words]], pa.large_binary())[1:]):
        for size in (3, 4, 8):
            assert [b and b.decode() for b in T.beginnings(own, size).to_pylist()] == [w[:size] if len(w) >= size else None for w in words]
    broken = [b"\x80\x80abc", b"ab", b"\xbf\xbf\xbf"]  # not UTF-8: no more than the word itself
    assert all(b is None or w.startswith(b) for w, b in zip(broken, T.beginnings(pa.array(broken, pa.large_binary()), 3).to_pylist(), strict=True))
    assert T.beginnings(pa.array([], pa.large_binary()), 3).to_pylist() == []


def test_logistic_curve_converges():
    """Classes that part well but for a few rows on the wrong side: the curve has the least loss, so its gradient is 0."""
    x = np.arcsinh(np.array([-50, 0, 1, 2, 3, 5, 8, 12, 33, 13, 15, 17, 20, 25, 33, 50.0]))
    y = np.array([0] * 9 + [1] * 7, float)
    weight = np.array([9000, 5000, 5000, 800, 200, 160, 40, 16, 4, 2, 10, 60, 300, 800, 1500, 5000.0])
    intercept, slope = T._logistic(x, y, weight)
    p = 1 / (1 + np.exp(-intercept - slope * x))
    assert abs(weight @ (y - p)) < 1e-2 and abs((weight * x) @ (y - p) - 1e-2 * slope) < 1e-2


def test_toxicity_query(spark, small):
    out = T.op13_toxicity(spark, "/root/testdata/sf0.01")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = out.join(marks, "doc_id").filter("held_out").select("predicted", "toxic", "score").collect()
    assert sum(r["predicted"] == r["toxic"] for r in got) / len(got) > 0.85 and len(got) > 80
    assert out.select("predicted").schema[0].dataType.simpleString() == "int"
