"""Ranked lexical search: for each item the documents of the highest BM25 scores, in whole numbers.

The items' terms are the vocabulary.  A tile of items has a compact vocabulary of its own, and a matrix of its terms'
weights; a tile of documents has a matrix of the impacts that those terms have in them.  Their product by BLAS, in
float64, holds the scores: every entry is a whole number, and a tile has so few terms that no partial sum reaches 2^53,
so that it is exact in whatever order BLAS adds.  Wider vocabularies are cut into several such products, added as
64-bit integers.

Of each product only what can still be among an item's first ones is looked at: what reaches the tile's k-th score, ties
included, and the k-th of those before it.  Each split of the documents then has k rows an item at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import blobs, keep, lean, local_rows, small_batches, steps
from .words import split_words

#: Items whose terms are searched in one pass over the documents have about so many terms together.
GROUP_TERMS = 200_000
ITEM_TILE, DOC_TILE, TERM_TILE = 64, 512, 4096
#: An impact is below 1000000, as 1000000000 * tf div (1000 * tf + ...) is.
IMPACT = 1_000_000
EXACT = 1 << 53
STEP = 1 << 20
NO_ID = np.iinfo(np.int64).max


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's distinct terms."""
    for batch in batches:
        parts, keys = blobs(batch["text"]), batch["item"].to_numpy()
        for lo, hi in steps([len(p) for p in parts], STEP):
            words = split_words(parts[lo:hi])
            encoded = words.array().dictionary_encode()
            pairs = np.unique(words.text_of() * max(1, len(encoded.dictionary)) + encoded.indices.to_numpy())
            text, term = np.divmod(pairs, max(1, len(encoded.dictionary)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[lo:hi][text]), encoded.dictionary.take(pa.array(term)).cast(pa.binary())], ["item", "term"])


def _hits(parts: list[bytes], vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and count of each vocabulary term in a document, and each document's number of words."""
    words = split_words(parts)
    encoded = words.array().dictionary_encode()
    known = pc.fill_null(pc.index_in(encoded.dictionary, vocabulary), -1).to_numpy().astype(np.int64)
    term = known[encoded.indices.to_numpy()] if len(known) else np.zeros(0, np.int64)
    found = term >= 0
    pairs, tf = np.unique(words.text_of()[found] * max(1, len(vocabulary)) + term[found], return_counts=True)
    doc, term = np.divmod(pairs, max(1, len(vocabulary)))
    return doc, term, tf, np.diff(words.cuts)


def _statistics(shipped):
    """For each split: documents that hold each vocabulary term; under -1 documents with terms, under -2 their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(shipped.value, pa.large_binary())
        df, docs, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            parts = blobs(batch["text"])
            for lo, hi in steps([len(p) for p in parts], STEP):
                _, term, _, n = _hits(parts[lo:hi], vocabulary)
                df += np.bincount(term, minlength=len(vocabulary))
                docs, total = docs + int(np.count_nonzero(n)), total + int(n.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, [-1, -2])), pa.array(np.append(df[seen], [docs, total]))], ["term", "n"])

    return lean(count)


class Tile:
    """Up to ``ITEM_TILE`` items: where each vocabulary term stands in their compact vocabulary, and the weights."""

    def __init__(self, items: np.ndarray, terms: np.ndarray, weights: np.ndarray, first: int):
        self.first, self.n = first, int(items[-1]) - first + 1
        self.known = np.unique(terms)
        self.weights = np.zeros((len(self.known), self.n))
        self.weights[np.searchsorted(self.known, terms), items - first] = weights[terms]

    def scores(self, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((n_docs, self.n), np.int64)
        at = np.minimum(np.searchsorted(self.known, term), len(self.known) - 1)
        mine = np.flatnonzero(self.known[at] == term)
        doc, at, impact = doc[mine], at[mine], impact[mine]
        for lo in range(0, len(self.known), width):
            hi = min(lo + width, len(self.known))
            part = slice(None) if hi - lo == len(self.known) else np.flatnonzero((at >= lo) & (at < hi))
            tile = np.zeros((n_docs, hi - lo))
            tile[doc[part], at[part] - lo] = impact[part]
            out += (tile @ self.weights[lo:hi]).astype(np.int64)
        return out


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """The places of each item's k first, by score and then by id, in order of the items."""
    order = np.lexsort((doc, -score, item))
    begins = np.flatnonzero(np.append(True, np.diff(item[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[place < k]


def _search(shipped, k: int, k1: int, b: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, items, owned, weights, n_docs, n_terms, n_items = shipped.value
        vocabulary = pa.array(terms, pa.large_binary())
        width = max(1, min(TERM_TILE, (EXACT - 1) // (IMPACT * max(1, int(weights.max(initial=0))))))
        edges = np.searchsorted(items, np.arange(0, n_items + ITEM_TILE, ITEM_TILE))
        tiles = [Tile(items[lo:hi], owned[lo:hi], weights, int(items[lo])) for lo, hi in zip(edges[:-1], edges[1:], strict=True) if hi > lo]
        held = [np.zeros(0, np.int64) for _ in range(3)]  # item, score, id of the first ones so far
        least = np.ones(n_items, np.int64)  # what a score must reach
        for batch in batches:
            parts = blobs(batch["text"])
            ids = batch["doc_id"].fill_null(NO_ID).to_numpy()
            for begin, end in steps([len(p) for p in parts], STEP):
                for lo in range(begin, end, DOC_TILE):
                    hi = min(lo + DOC_TILE, end)
                    doc, term, tf, n = _hits(parts[lo:hi], vocabulary)
                    m = np.array([100 - b + (b * x * n_docs) // max(1, n_terms) for x in n.tolist()], np.int64)
                    impact = (1_000_000_000 * tf) // (1000 * tf + k1 * m[doc])
                    new = [held]
                    for tile in tiles:
                        score = tile.scores(hi - lo, doc, term, impact, width)
                        bar = least[tile.first : tile.first + tile.n]
                        if hi - lo > k:
                            bar = np.maximum(bar, np.partition(score, hi - lo - k, axis=0)[hi - lo - k])
                        d, i = np.nonzero(score >= bar)
                        new.append([i + tile.first, score[d, i], ids[lo:hi][d]])
                    held = [np.concatenate(c) for c in zip(*new, strict=True)]
                    kept = _best(held[0], held[1], held[2], k)
                    held = [c[kept] for c in held]
                    last = np.flatnonzero(np.bincount(held[0], minlength=n_items) == k)
                    least[last] = held[1][np.searchsorted(held[0], last, side="right") - 1]
        ids = pa.array(held[2], mask=held[2] == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), ids, pa.array(held[1])], ["item", "doc_id", "score"])

    return lean(search)


def top_documents(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", k: int = 10, k1: int = 8, b: int = 90) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``k`` best documents with a score above 0 (fewer if there are no more).

    ``k1`` is BM25's in tenths, ``b`` its b in percent.  Equal scores stand by ascending id, null ids last.  Null and empty
    texts have no terms: such an item has no rows, such a document is in none, and doesn't count.  Texts of any length
    count whole.  Repeated documents are documents each; a repeated item has its rows as often.  Empty tables give no
    rows.  Other columns are not read, so their names can't clash.

    Items are taken in groups of about ``GROUP_TERMS`` terms, by a hash of their number; each group reads the documents
    twice, for the statistics and for the scores.  Only a group's terms are on the driver and broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    numbered = keep(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")), "items")
    terms = keep(numbered.select("item", "text").mapInArrow(lean(_terms), "item long, term binary"), "terms")
    groups = max(1, -(-terms.count() // GROUP_TERMS))
    out = None
    for group in range(groups):
        mine = F.pmod(F.xxhash64("item"), F.lit(groups)) == group
        found = _group(spark, texts, terms.filter(mine), k, k1, b).join(numbered.select("item", "item_id").filter(mine), "item")
        found = found.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def _group(spark, texts: DataFrame, terms: DataFrame, k: int, k1: int, b: int) -> DataFrame:
    """``item, doc_id, score, rank`` for the items of ``terms``, a table of about ``GROUP_TERMS`` rows."""
    pairs = terms.toArrow().combine_chunks()
    encoded = pairs["term"].combine_chunks().cast(pa.large_binary()).dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    vocabulary, owned = encoded.dictionary.to_pylist(), encoded.indices.to_numpy().astype(np.int64)
    keys, items = np.unique(pairs["item"].to_numpy(), return_inverse=True)
    order = np.lexsort((owned, items))
    items, owned = items[order].astype(np.int64), owned[order]
    words = spark.sparkContext.broadcast(vocabulary)
    counted = texts.select("text").mapInArrow(_statistics(words), "term long, n long").groupBy("term").agg(F.sum("n"))
    n = dict(map(tuple, counted.collect()))  # one row for each term of the group
    n_docs, n_terms = n.get(-1, 0), n.get(-2, 0)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
    shipped = spark.sparkContext.broadcast((vocabulary, items, owned, weights, n_docs, n_terms, len(keys)))
    best = texts.mapInArrow(_search(shipped, k, k1, b), "item long, doc_id long, score long")
    # Splits' first ones meet in 64 parts an item before they meet all.
    first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item", "_part").orderBy(*first)
    best = best.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(64))).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*first))).filter(F.col("rank") <= k)
    names = local_rows(spark, "item long, key long", [(i, int(x)) for i, x in enumerate(keys)])
    return best.join(F.broadcast(names), "item").select(F.col("key").alias("item"), "doc_id", "score", "rank")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    return top_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
words AS (SELECT doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT doc_id, len(terms) AS n FROM words WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
hits AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM words) WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM hits, total GROUP BY term, docs),
impacts AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)) AS impact FROM hits JOIN sizes USING (doc_id), total),
scores AS (SELECT item_id, doc_id, sum(w * impact)::BIGINT AS score FROM items JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL HAVING score > 0),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
"""
