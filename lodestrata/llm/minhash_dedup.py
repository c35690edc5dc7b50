"""Near-duplicates by word shingles: MinHash signatures, banding, signature and set verification, components.

1. Each text becomes its set of shingles (64-bit hashes) and a signature of ``HASHES`` minima under universal hashes.
2. Texts with equal sets are one node from here on.
3. Nodes that share a band meet in a bucket; buckets with the same members are one.  Within a bucket signatures are
   compared, and a node stays with those whose estimate comes near the threshold.
4. The clusters that arise are small; their members' whole sets meet once and are compared exactly.  A member of the
   largest part needs no comparison with its own part, so that a group of thousands costs few of them.
5. Exact links, as a spanning forest, go to the components.

Large buckets and clusters are cut into tiles, by rows and by the size of their sets.  One member, the pivot, is in all
tiles of its group; only members that no link joins to the pivot (in a tight group few) then meet all others in further
tiles.  Nothing is capped, no task holds a whole group, and a group of near copies costs time in proportion to its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, parts_of, pivot_tiles, runs, stray_tiles
from .shared import blobs, keep, lean, local_components, meet, padded, small_batches, steps
from .words import binary_array

WORDS = 5
BANDS, BAND_ROWS = 20, 5
HASHES = BANDS * BAND_ROWS
#: An estimate below this can't be of a pair at 0.85 (5 standard deviations of HASHES minima).
SLACK = 0.17
#: Members of a tile, and shingles of their sets in one where these are compared (4 MB).
TILE_ROWS, TILE_SHINGLES = 512, 500_000
#: A table of ids of so many rows at most (about 16 MB) may be broadcast.
SMALL_ROWS = 400_000

_draw = np.random.default_rng(20240601)
POWER = np.uint64(0x9E3779B97F4A7C15 | 1)
SHINGLE_FACTORS = _draw.integers(1, 1 << 63, (WORDS + 1, WORDS), dtype=np.uint64) | np.uint64(1)
FACTORS = _draw.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
OFFSETS = _draw.integers(1, 1 << 63, HASHES, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each word's BLAKE2; each distinct word is hashed once.

    Sums over letters would be faster, but have words that always collide, and links are confirmed on these hashes.
    """
    inside = np.zeros(len(buffer) + 1, np.int8)
    inside[begin] = 1
    inside[end] = -1
    data = LOWER[buffer[np.cumsum(inside[:-1], dtype=np.int8) > 0]]
    encoded = binary_array(data, np.append(0, np.cumsum(end - begin))).dictionary_encode()
    each = b"".join([hashlib.blake2b(w, digest_size=8).digest() for w in encoded.dictionary.to_pylist()])
    return np.frombuffer(each or bytes(8), np.uint64)[encoded.indices.to_numpy()]


def shingle_sets(parts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for lo, hi in steps([len(p) for p in parts], 1 << 20):
        buffer, starts, ends = padded(parts[lo:hi], b" ")
        blank = BLANK[buffer]
        begin = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
        end = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        word = word_hashes(buffer, begin, end)
        at = np.searchsorted(begin, np.append(starts, len(buffer)))
        count = max(0, len(word) - WORDS + 1)
        five = np.zeros(count, np.uint64)
        for i in range(WORDS):
            five += word[i : i + count] * SHINGLE_FACTORS[WORDS, i]
        five = _mix(five)
        for first, last in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            n = last - first
            if n >= WORDS:
                own = five[first : last - WORDS + 1].copy()
                own.sort()
                out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif n:
                out.append(_mix(np.array([(word[first:last] * SHINGLE_FACTORS[n, :n]).sum()], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of HASHES minima for each set; empty sets have zeros."""
    out = np.zeros((len(sets), HASHES), np.uint32)
    for lo, hi in steps([len(s) for s in sets], 100_000):
        full = [i for i in range(lo, hi) if len(sets[i])]
        if full:
            flat = np.concatenate([sets[i] for i in full])
            at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
            for k in range(HASHES):
                out[full, k] = np.minimum.reduceat(flat * FACTORS[k] + OFFSETS[k], at) >> np.uint64(32)
    return out


SIGNED = "doc_id long, n_shingles long, digest binary, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = blobs(batch["text"])
        names = batch["doc_id"]
        for lo, hi in steps([len(p) for p in parts]):
            sets = shingle_sets(parts[lo:hi])
            rows = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    names.slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "signature"],
            )


def _matrix(column, kind) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _matrix(batch["signature"], np.uint32).astype(np.uint64).reshape(batch.num_rows, BANDS, BAND_ROWS)
        keys = _mix((rows * SHINGLE_FACTORS[WORDS]).sum(axis=2) + np.arange(1, BANDS + 1, dtype=np.uint64) * POWER)
        names = np.repeat(batch["doc_id"].to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(names)], ["key", "doc_id"])


def _stars(names: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, label, names)
    to = least[label]
    other = to != names
    return pa.RecordBatch.from_arrays([pa.array(names[other]), pa.array(to[other])], ["u", "v"])


def _alike(threshold: float):
    """Stars over the members of a tile whose signatures agree in enough places."""
    need = int(np.ceil((threshold - SLACK) * HASHES))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "tile"):
            names, rows = table["doc_id"].to_numpy(), _matrix(table["signature"], np.uint32)
            n = len(names)
            us, vs = [], []
            step = max(1, 2_000_000 // (n * HASHES))
            for i in range(0, n, step):
                u, v = np.nonzero((rows[i : i + step, None, :] == rows[None, :, :]).sum(axis=2) >= need)
                ahead = u + i < v
                us.append(u[ahead] + i)
                vs.append(v[ahead])
            yield _stars(names, local_components(n, np.concatenate(us), np.concatenate(vs)))

    return alike


def _emit_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, names, dealt = blobs(batch["text"]), batch["doc_id"].to_pylist(), batch["tiles"].to_pylist()
        for lo, hi in steps([len(p) for p in parts], 1 << 20):
            rows = [(t, d, s.tobytes()) for s, d, own in zip(shingle_sets(parts[lo:hi]), names[lo:hi], dealt[lo:hi], strict=True) for t in own]
            if rows:
                tile, doc, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int64()), pa.array(doc, pa.int64()), pa.array(data, pa.binary())], ["tile", "doc_id", "shingles"])


def exact_parts(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Components of the exact links between sets: 100 x intersection >= percent x union.

    A set is compared with all others at once, by the postings of its shingles.  Sets of the largest part so far are
    left for last: when only they remain, every other set has met all, and no further link can join two parts.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    label = np.arange(n)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    ordered = flat[order]
    first = np.searchsorted(ordered, flat, "left")
    last = np.searchsorted(ordered, flat, "right")
    at = np.concatenate([[0], np.cumsum(sizes)])
    waiting = np.ones(n, bool)
    while True:
        counts = np.bincount(label, minlength=n)
        todo = np.flatnonzero(waiting & (label != counts.argmax())) if counts.max() > 1 else np.flatnonzero(waiting)
        if not len(todo):
            return label
        i = todo[0]
        waiting[i] = False
        lo, hi = first[at[i] : at[i + 1]], last[at[i] : at[i + 1]]
        lens = hi - lo
        places = np.repeat(hi - np.cumsum(lens), lens) + np.arange(lens.sum())
        shared = np.bincount(owner[places], minlength=n)
        linked = np.flatnonzero(100 * shared >= percent * (sizes + sizes[i] - shared))
        parts = np.unique(label[linked])
        label[np.isin(label, parts)] = parts[0]


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "tile"):
            names = table["doc_id"].to_numpy()
            sets = [np.frombuffer(b, np.uint64) for b in table["shingles"].to_pylist()]
            yield _stars(names, exact_parts(sets, percent))

    return verify


def _by_tile(dealt: DataFrame, content: DataFrame, work) -> DataFrame:
    """Run ``work`` on each tile of ``dealt`` (tile, doc_id); signatures are joined, whole texts are read again as sets."""
    if "signature" in content.columns:
        rows = dealt.join(content, "doc_id")
    else:
        dealt = keep(dealt.groupBy("doc_id").agg(F.collect_list("tile").alias("tiles")), "tiles")
        few = dealt.count() <= SMALL_ROWS
        rows = content.join(F.broadcast(dealt) if few else dealt, "doc_id").select("doc_id", "text", "tiles")
        rows = rows.mapInArrow(lean(_emit_sets), "tile long, doc_id long, shingles binary")
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(lean(work), "u long, v long")


def _linked(members: DataFrame, key: str, content: DataFrame, work) -> DataFrame:
    """Links within the groups of ``members`` (key, doc_id, t, pivot), as stars: first in tiles with the pivot, then of strays."""
    members = keep(members.select(key, "doc_id", "t", "pivot"), "members")
    links = _by_tile(pivot_tiles(members, key, "doc_id"), content, work)
    if members.filter("t > 1").isEmpty():
        return links
    links = keep(links, "links")
    dealt = keep(stray_tiles(members, links, key, "doc_id", TILE_ROWS), "stray-tiles")
    return links if dealt.isEmpty() else links.union(_by_tile(dealt, content, work))


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Null, empty and blank texts have no shingles and are linked with nothing; fewer than five words are one shingle.
    Texts of any length count whole.  Equal sets are always linked.  Repeated rows of one id are one node: each gets a row,
    and all are kept if the id is its component's least.  A null id is linked with nothing and not kept.  Pairs at the
    threshold are found with all but 1e-5 of probability, nearer ones more surely; no pair below it is ever linked.
    An empty table gives no rows; other columns are not read, so their names can't clash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = keep(rows.mapInArrow(lean(_sign), SIGNED), "signed")
    linkable = signed.filter("n_shingles > 0 and doc_id is not null")
    same = keep(linkable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "same")
    nodes = linkable.join(same.select("digest", "doc_id"), ["digest", "doc_id"], "left_semi")
    nodes = keep(nodes.select("doc_id", "n_shingles", "digest", "signature").dropDuplicates(["doc_id", "digest"]), "nodes")
    bands = keep(nodes.mapInArrow(lean(_band_keys), "key long, doc_id long"), "bands")
    buckets = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("pivot"), F.bit_xor(F.xxhash64("doc_id")).alias("mark")).filter("n > 1")
    buckets = keep(buckets.groupBy("n", "pivot", "mark").agg(F.min("key").alias("key")).select("key", "n", "pivot"), "buckets")
    members = meet(bands, buckets, ["key"], "n").withColumn("t", parts_of(F.col("n"), TILE_ROWS))
    guesses = _linked(members, "key", nodes.select("doc_id", "signature"), _alike(percent / 100))
    clusters = keep(components(guesses).withColumnRenamed("node", "doc_id"), "clusters")
    sized = clusters.join(nodes.select("doc_id", "n_shingles"), "doc_id")
    sizes = keep(sized.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")), "sizes")
    members = meet(clusters, sizes, ["component"], "n").withColumn("t", parts_of(F.col("n"), TILE_ROWS, F.col("shingles"), TILE_SHINGLES))
    links = _linked(members.withColumn("pivot", F.col("component")), "component", rows, _verify(percent))
    found = components(links)
    root = same.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("digest", F.coalesce("component", "doc_id").alias("root"), "n")
    out = meet(signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest")), keep(root, "roots"), ["digest"], "n", "left")
    own = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
    return own.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op3_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
same AS (SELECT min(doc_id) AS id, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
flat AS (SELECT id, len(s) AS n, hash(x) AS h FROM (SELECT id, s, unnest(s) AS x FROM same)),
links AS (
  SELECT a.id AS u, b.id AS v FROM flat a JOIN flat b ON a.h = b.h AND a.id < b.id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT id AS node, id AS root FROM same WHERE id IN (SELECT u FROM both_ways)
          UNION SELECT b.v, r.root FROM reach r JOIN both_ways b ON b.u = r.node WHERE r.root < b.v OR r.root < r.node),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT sets.doc_id, len(sets.s) AS n_shingles, coalesce(comp.root, same.id, sets.doc_id) AS component_id,
       sets.doc_id = coalesce(comp.root, same.id, sets.doc_id) AS kept
FROM sets LEFT JOIN same ON list_sort(sets.s) = same.s LEFT JOIN comp ON comp.node = same.id
"""
