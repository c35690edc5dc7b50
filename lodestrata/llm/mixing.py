"""Mixing sources to target weights.

Each source's words form a stream: its documents in a pseudorandom order, cut into blocks of ``BLOCK_WORDS`` words, of
which the last may be shorter.  The mix is a row of slots in output shards, and a source has as many slots as its target
needs: whole passes over all its blocks, and then some blocks more, the last of them in part, so that the words taken are
the target's.  The numbers of slots that each shard has of a source are drawn multinomially, given the source's total: at
first over groups of shards, then over the shards of each group, by generators that are seeded by source and group, so
that any task can draw its part.  A source's slots are numbered through; in each pass, slot k takes block
``permutation(k)``, so that no block is taken again before all others are.  Slots and blocks are joined by source and
block index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from .shared import keep, local_rows, small_batches

#: Weights by the sources' order, repeating, and the most that a source may be repeated.
WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 128
#: About how many slots a shard has at most, and how many shards a smaller mix is dealt to; shards of a group; slots, or
#: equal rows, that one task's step numbers at once.
SHARD_SLOTS, LEAST_SHARDS, GROUP_SHARDS, CHUNK_SLOTS = 1 << 16, 64, 1 << 10, 1 << 13
#: Documents of a bucket, and buckets of a stretch, in which running sums are made.
DOCS_A_BUCKET, BUCKETS_A_STRETCH = 500, 500
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Source:
    """``words`` are taken in ``passes`` over all blocks and then of ``more`` whole ones and a part of one."""

    name: str | None
    size: int
    target: float

    @property
    def words(self) -> int:
        return round(self.target)

    @property
    def full(self) -> int:
        return self.size // BLOCK_WORDS

    @property
    def blocks(self) -> int:
        return -(-self.size // BLOCK_WORDS)

    @property
    def passes(self) -> int:
        return self.words // self.size if self.size else 0

    @property
    def rest(self) -> int:
        """Words of the last pass, which takes full blocks before the shorter one."""
        return self.words - self.passes * self.size

    @property
    def slots(self) -> int:
        return self.passes * self.blocks + -(-self.rest // BLOCK_WORDS)


def targets(sizes: list[int], weights: list[float], repeats: float = REPEATS) -> list[float]:
    """Shares of the total size by weight; none above ``repeats`` times its own size, the excess reshared by weight."""
    out, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in sorted(open_))
        share = {i: left * weights[i] / total for i in open_}
        over = sorted(i for i in open_ if share[i] > repeats * sizes[i])
        if not over:
            for i in open_:
                out[i] = share[i]
            break
        for i in over:
            out[i] = float(repeats * sizes[i])
            left -= out[i]
            open_.discard(i)
    return out


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 for each key: a Feistel network whose values outside are walked on."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    value, size = index.astype(np.uint64), size.astype(np.uint64)
    todo = np.arange(len(value))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = value[todo] >> h, value[todo] & m
        for turn in range(4):
            x = (right + k + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & m)
        value[todo] = (left << h) | right
        todo = todo[value[todo] >= size[todo]]
    return value.astype(np.int64)


def block_and_limit(k: np.ndarray, size: np.ndarray, words: np.ndarray, source: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of slot k of a source of that size and those words, and how many of the block's words it takes at most."""
    full, blocks, passes = size // BLOCK_WORDS, -(-size // BLOCK_WORDS), words // size
    turn = np.minimum(k // blocks, passes)
    at, last = k - turn * blocks, turn == passes
    rest = words - passes * size
    among = np.where(last, full, blocks)
    key = (source.astype(np.uint64) * np.uint64(1_000_003) + turn.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed)
    inside = at < among
    block = np.where(inside, permute(np.where(inside, at, 0), np.maximum(among, 1), key), at)
    return block, np.where(last, np.minimum(BLOCK_WORDS, rest - at * BLOCK_WORDS), BLOCK_WORDS)


def draw_groups(n_shards: int, seed: int):
    """Slots of each source in each group of shards: ``s, part, first, n``."""
    groups = -(-n_shards // GROUP_SHARDS)
    shares = np.array([min(GROUP_SHARDS, n_shards - g * GROUP_SHARDS) for g in range(groups)], float) / max(n_shards, 1)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, slots in zip(batch["s"].to_pylist(), batch["slots"].to_pylist(), strict=True):
                yield _spread(s, np.arange(groups), 0, np.random.default_rng([seed, s]).multinomial(slots, shares / shares.sum()))

    return draw


def draw_shards(n_shards: int, seed: int):
    """Slots of each source in each shard of a group: ``s, part, first, n``."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, group, first, n in zip(*(batch[c].to_pylist() for c in ("s", "part", "first", "n")), strict=True):
                shards = np.arange(group * GROUP_SHARDS, min((group + 1) * GROUP_SHARDS, n_shards))
                yield _spread(s, shards, first, np.random.default_rng([seed, s, group]).multinomial(n, np.full(len(shards), 1 / len(shards))))

    return draw


def _spread(s: int, parts: np.ndarray, first: int, counts: np.ndarray) -> pa.RecordBatch:
    begins = first + np.cumsum(counts) - counts
    some = counts > 0
    return pa.RecordBatch.from_arrays([pa.array(np.full(some.sum(), s, np.int32)), pa.array(parts[some]), pa.array(begins[some]), pa.array(counts[some])], ["s", "part", "first", "n"])


_DRAWN = "s int, part long, first long, n long"


def shards_of(slots: int, shard_slots: int = SHARD_SLOTS) -> int:
    """Shards of a mix of so many slots: as many as shards of that size need, and some tens if there are slots for them."""
    return max(1, -(-slots // shard_slots), min(LEAST_SHARDS, slots // 16))


def plan_shards(spark, sources: list[Source], seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``s, part, first, n``: which slots of each source are in each shard (part); drawn on the executors."""
    n_shards = shards_of(sum(s.slots for s in sources), shard_slots)
    table = local_rows(spark, "s int, slots long", [(i, s.slots) for i, s in enumerate(sources) if s.slots])
    groups = table.repartition("s").mapInArrow(draw_groups(n_shards, seed), _DRAWN)
    return groups.repartition("s", "part").mapInArrow(draw_shards(n_shards, seed), _DRAWN)


@dataclass(frozen=True)
class Mix:
    """``documents``: row_key, doc_id, source index ``s``, ``begin``, ``size``; ``slots``: shard, slot, s, block, words."""

    sources: list[Source]
    documents: DataFrame
    slots: DataFrame

    def fragments(self) -> DataFrame:
        """The part of each document in each block it lies in: ``s, block, row_key, doc_id, begin, size, from_word, at, words``.

        The part has the document's words from ``from_word`` on and the block's from ``at`` on.
        """
        last = F.expr(f"(begin + size - 1) div {BLOCK_WORDS}")
        rows = self.documents.filter("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"begin div {BLOCK_WORDS}"), last)))
        edge = F.col("block") * BLOCK_WORDS
        low, high = F.greatest(F.col("begin"), edge), F.least(F.col("begin") + F.col("size"), edge + BLOCK_WORDS)
        return rows.select("s", "block", "row_key", "doc_id", "begin", "size", (low - F.col("begin")).alias("from_word"), (low - edge).alias("at"), (high - low).alias("words"))

    def drawn(self) -> DataFrame:
        """How often each fragment is taken whole (``times``), and of how many of its words one slot more takes the first (``first_words``).

        ``places`` is a digest of the shards and slots that its block has.
        """
        whole = F.col("limit") == BLOCK_WORDS
        counts = self.slots.groupBy("s", "block").agg(F.bit_xor(F.xxhash64("shard", "slot")).alias("places"), F.count_if(whole).alias("times"), F.coalesce(F.max(F.when(~whole, F.col("limit"))), F.lit(0)).alias("part"))
        first = F.greatest(F.lit(0), F.least(F.col("words"), F.col("part") - F.col("at")))
        return self.fragments().join(counts, ["s", "block"]).withColumn("first_words", first).drop("part")

    def blocks(self) -> DataFrame:
        """The mix itself: ``shard, slot, source, block, parts`` with the parts (doc_id, from_word, words) in order."""
        parts = self.fragments().groupBy("s", "block").agg(F.sort_array(F.collect_list(F.struct("begin", "doc_id", "from_word", "at", "words"))).alias("parts"))
        names = local_rows(self.slots.sparkSession, "s int, source string", [(i, s.name) for i, s in enumerate(self.sources)])
        joined = self.slots.join(parts, ["s", "block"]).join(F.broadcast(names), "s")  # one row a source
        cut = F.transform("parts", lambda p: F.struct(p["doc_id"], p["from_word"], F.least(p["words"], F.col("limit") - p["at"]).alias("words")))
        return joined.select("shard", "slot", "source", "block", F.filter(cut, lambda p: p["words"] > 0).alias("parts"))

    def taken(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken, places`` for every row of the input.

        ``places`` is a digest of the shards and slots in which the row's blocks are, 0 for a row that isn't taken.
        """
        words = self.drawn().groupBy("s", "begin").agg(F.sum(F.col("words") * F.col("times") + F.col("first_words")).alias("taken"), F.bit_xor("places").alias("places"))
        of = local_rows(self.slots.sparkSession, "s int, source_size long, target double", [(i, s.size, s.target) for i, s in enumerate(self.sources)])
        full = self.documents.filter("size > 0").join(words, ["s", "begin"], "left").select("doc_id", "s", "size", F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("places", F.lit(0)).alias("places"))
        none = self.documents.filter("size = 0").select("doc_id", "s", "size", F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("places"))
        return full.union(none).join(F.broadcast(of), "s").select("doc_id", "size", "source_size", "target", "taken", "places")

    def pieces(self) -> DataFrame:
        """What is taken of each row: ``row_key, from_word, words, times``; a whole row has its size as ``words``.

        A row is taken whole as often as each of its blocks is; what is left is a piece for each fragment.  Equal rows
        have one key, and their pieces are added up.
        """
        drawn = keep(self.drawn(), "drawn")
        whole = drawn.groupBy("s", "begin").agg(F.min("times").alias("least"), F.count("*").alias("n"), F.max(F.expr(f"(begin + size - 1) div {BLOCK_WORDS} - begin div {BLOCK_WORDS} + 1")).alias("of"))
        whole = whole.withColumn("least", F.when(F.col("n") == F.col("of"), F.col("least")).otherwise(0)).drop("n", "of")
        rows = drawn.join(whole, ["s", "begin"])
        parts = rows.select("row_key", "from_word", "words", (F.col("times") - F.col("least")).alias("times"))
        first = rows.select("row_key", "from_word", F.col("first_words").alias("words"), F.lit(1).cast("long").alias("times"))
        full = rows.filter("from_word = 0").select("row_key", F.lit(0).cast("long").alias("from_word"), F.col("size").alias("words"), F.col("least").alias("times"))
        every = parts.union(first).union(full).filter("times > 0 and words > 0")
        return every.groupBy("row_key", "from_word", "words").agg(F.sum("times").cast("int").alias("times"))


def row_key(docs: DataFrame) -> Column:
    """A key that rows share only if all their columns are equal."""
    cell = lambda f: F.col(f.name).cast("string") if isinstance(f.dataType, AtomicType) else F.to_json(F.struct(f.name))
    return F.unhex(F.md5(F.concat_ws("\x1f", *[F.coalesce(cell(f), F.lit("\x00null")) for f in docs.schema])))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = 7) -> Mix:
    """Plan and draw a mix of all documents.

    A document's size is its number of words; null and empty texts have none and are never taken.  Sources are ordered by
    code point with null last.  The list of sources, one row each, is on the driver, as weights are by source; slots,
    shards and documents are not.  Repeated rows are documents of their own.  Rows without an id are mixed as others.
    Long texts lie in many blocks.  An empty table has no sources, slots or rows.  The same rows give the same mix, however
    they are partitioned.  A source's words are its target's, rounded to a word, so that small sources aren't lost.
    """
    spark = docs.sparkSession
    small_batches(spark, 10_000)
    size = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    thin = keep(docs.select(row_key(docs).alias("row_key"), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size")), "sizes")
    found = [(r["source"], int(r["size"]), int(r["n"])) for r in thin.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()]
    found.sort(key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [x[1] for x in found]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], repeats)
    sources = [Source(name, size, goal) for (name, size, _), goal in zip(found, goals, strict=True)]
    index = local_rows(spark, "s int, name string", [(i, s.name) for i, s in enumerate(sources)])
    buckets = max(1, -(-sum(x[2] for x in found) // DOCS_A_BUCKET))
    bucket = F.pmod(F.xxhash64("row_key", F.lit(seed)), F.lit(buckets))
    known = thin.join(F.broadcast(index), thin["source"].eqNullSafe(index["name"])).groupBy("row_key", "doc_id", "s", "size").agg(F.count("*").alias("copies"))
    # Equal rows are one here, whose copies stand side by side, so that no bucket gets all copies of a row.
    known = keep(known.withColumn("bucket", bucket).withColumn("all", F.col("size") * F.col("copies")), "known")
    # A running sum in three steps: stretches of a source, buckets of a stretch, documents of a bucket.
    stretch = F.expr(f"bucket div {BUCKETS_A_STRETCH}")
    sums = keep(known.groupBy("s", stretch.alias("stretch"), "bucket").agg(F.sum("all").alias("n")), "bucket-sums")
    far = sums.groupBy("s", "stretch").agg(F.sum("n").alias("n"))
    far = far.select("s", "stretch", (F.sum("n").over(Window.partitionBy("s").orderBy("stretch")) - F.col("n")).alias("far"))
    near = F.sum("n").over(Window.partitionBy("s", "stretch").orderBy("bucket")) - F.col("n")
    base = sums.select("s", "stretch", "bucket", near.alias("near")).join(far, ["s", "stretch"]).select("s", "bucket", (F.col("near") + F.col("far")).alias("base"))
    inside = F.sum("all").over(Window.partitionBy("s", "bucket").orderBy("row_key").rowsBetween(Window.unboundedPreceding, -1))
    placed = known.withColumn("inside", F.coalesce(inside, F.lit(0))).join(base, ["s", "bucket"])
    placed = placed.withColumn("from", F.explode(F.expr(f"sequence(0L, copies - 1, {CHUNK_SLOTS}L)")))
    if (known.agg(F.max("copies")).first()[0] or 0) > CHUNK_SLOTS:
        placed = placed.repartition("row_key", "from")
    copy = F.explode(F.expr(f"sequence(from, least(copies, from + {CHUNK_SLOTS}) - 1)")).alias("copy")
    placed = placed.select("row_key", "doc_id", "s", "size", "base", "inside", copy)
    documents = keep(placed.select("row_key", "doc_id", "s", "size", (F.col("base") + F.col("inside") + F.col("copy") * F.col("size")).alias("begin")), "placed")
    counts = plan_shards(spark, sources, seed)
    chunk = counts.withColumn("from", F.explode(F.expr(f"sequence(0L, n - 1, {CHUNK_SLOTS}L)"))).repartition("s", "first", "from")
    slot = chunk.select(F.col("part").alias("shard"), "s", F.explode(F.expr(f"sequence(first + from, first + least(n, from + {CHUNK_SLOTS}) - 1)")).alias("k"))
    size_of, words_of = np.array([max(1, s.size) for s in sources] or [1], np.int64), np.array([s.words for s in sources] or [1], np.int64)

    @F.arrow_udf("struct<block: bigint, limit: bigint>")
    def place(s: pa.Array, k: pa.Array) -> pa.Array:
        which = s.to_numpy()
        block, limit = block_and_limit(k.to_numpy(), size_of[which], words_of[which], which, seed)
        return pa.StructArray.from_arrays([pa.array(block), pa.array(limit)], ["block", "limit"])

    slots = slot.select("shard", F.xxhash64("s", "k", F.lit(seed)).alias("slot"), "s", place("s", "k").alias("_p")).select("shard", "slot", "s", "_p.block", "_p.limit")
    # Kept, as the planner takes what is exploded from a small table for small, and would broadcast it.
    return Mix(sources, documents, keep(slots, "slots"))


def mixed_rows(docs: DataFrame, text: str = "text", length: str | None = None, **how) -> DataFrame:
    """The mix as rows with the columns of ``docs``: each row as often as it is taken whole, and what is taken in part.

    A part is a row with the words' own text, with the blanks between them; ``length`` names a column that then holds its
    number of characters.  The words of each source are its target's.
    """
    pieces = keep(mix(docs, text=text, **how).pieces(), "pieces")
    own = lambda name: name if name not in docs.columns else own(name + "_")
    key, taken, cells, out = (own(f"_{x}") for x in ("key", "taken", "cells", "out"))
    wanted = pieces.groupBy(F.col("row_key").alias(key)).agg(F.sort_array(F.collect_list(F.struct("from_word", "words", "times"))).alias(taken))
    rows = docs.withColumn(key, row_key(docs))
    repeated = keep(rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key), "repeated")
    if not repeated.isEmpty():  # equal rows are one, with the pieces of all
        rows = rows.join(repeated, key, "left_anti").unionByName(rows.join(repeated, key, "left_semi").dropDuplicates([key]))
    # Exploding one value keeps it from being computed for each piece; a text that is only taken whole isn't cut.
    parts = F.exists(taken, lambda p: (p["from_word"] > 0) | (p["words"] < F.regexp_count(F.col(text), F.lit(WORD))))
    cut = F.when(parts, F.regexp_extract_all(F.col(text), F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0)))
    joined = rows.join(wanted, key).select("*", F.explode(F.array(cut)).alias(cells))
    whole = lambda p: F.col(cells).isNull() | ((p["from_word"] == 0) & (p["words"] == F.size(cells)))
    piece = lambda p: F.struct(whole(p).alias("whole"), F.when(~whole(p), F.array_join(F.slice(cells, p["from_word"].cast("int") + 1, p["words"].cast("int")), "")).alias("part"), p["times"].alias("times"))
    joined = joined.withColumn(out, F.explode(F.transform(taken, piece)))
    new = {text: F.when(F.col(out)["whole"], F.col(text)).otherwise(F.col(out)["part"])}
    if length in docs.columns:
        new[length] = F.when(F.col(out)["whole"], F.col(length)).otherwise(F.length(F.col(out)["part"])).cast(docs.schema[length].dataType)
    times = F.explode(F.sequence(F.lit(1), F.col(out)["times"])).alias(own("_time"))
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns], times).select(*docs.columns)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).taken()
