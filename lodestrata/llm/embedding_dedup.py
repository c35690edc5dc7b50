"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors a cosine of at least c is a squared distance of at most D = 2 - 2c.  After a random rotation the vectors
are cut into ``BLOCKS`` blocks of coordinates; if a pair's squared distance is at most D, then in at least one block it is
at most that block's share of D, which is in proportion to its width.  So each block is a range join of its own: on its
first coordinates, vectors lie in cells as wide as the block's radius, and a pair meets in its cell or in neighbouring
ones.  How many coordinates make a cell depends on how many vectors a label has, so that cells stay small: with each one a
vector is in twice as many cells.  A task takes the pairs within the block's budget that no earlier block has, and verifies
them by their cosine in double precision.  Only counts and a spanning forest of the links leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, runs
from .shared import keep, local_components, meet, small_batches

BLOCKS = 4
#: Vectors of a part of a cell, and the most coordinates that make a cell.
TILE_ROWS, MOST_AXES = 8192, 8
#: About the share of a cell's vectors that its fullest subcell has.
SUBCELL_SHARE = 0.45
#: A table of cells or labels of so many rows at most may be broadcast (some 10 MB).
SMALL_ROWS = 100_000
#: Room for rounding in the rotated coordinates; candidates are verified exactly.
ROUNDING = 1e-6


def rotation(width: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(width).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def edges_of(width: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, width, min(BLOCKS, width) + 1).astype(int).tolist()
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _budgets(width: int, cosine: float) -> np.ndarray:
    return np.array([(2 - 2 * cosine) * (b - a) / width for a, b in edges_of(width)])


def _vectors(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Lengths are taken after scaling by the largest component, so that none overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _deal(cosine: float, thin: bool):
    """A row for each block and cell where the vector is at home or, along some of the axes, a guest of the next lower cell.

    Bit i of ``guest`` is set if it is a guest along axis i.  Two vectors whose cells are the same or neighbours along
    each axis have one cell in which no axis has both as guests.  ``thin`` rows have the cell and ``guest`` only.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = np.stack([batch["width"].to_numpy(), batch["axes"].to_numpy()], axis=1)
            for w, most in np.unique(kinds, axis=0).tolist() if len(kinds) else []:
                own = batch.filter(pa.array((kinds == (w, most)).all(axis=1)))
                turned, n = _unit(_vectors(own["vector"])) @ rotation(w), own.num_rows
                for b, ((first, last), budget) in enumerate(zip(edges_of(w), _budgets(w, cosine), strict=True)):
                    axes = min(most, last - first)
                    cell = np.floor(turned[:, first : first + axes] / (np.sqrt(budget) + ROUNDING)).astype(">i4")
                    for guest in range(1 << axes):
                        moved = cell - np.array([guest >> i & 1 for i in range(axes)], ">i4")
                        names = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * axes), n, [None, pa.py_buffer(np.ascontiguousarray(moved.astype(">i4")).tobytes())]).cast(pa.binary())
                        key = [own["label"], pa.array(np.full(n, w, np.int32)), pa.array(np.full(n, b, np.int32)), names, pa.array(np.full(n, guest, np.int32))]
                        yield pa.RecordBatch.from_arrays(key if thin else [*key, own["vec_id"], own["copies"], own["vector"]], _DEALT[: 5 if thin else None])

    return deal


_DEALT = ["label", "width", "block", "cell", "guest", "vec_id", "copies", "vector"]
_CELL = "label string, width int, block int, cell binary, guest int"


def _link(cosine: float):
    """Links found in a tile: (vec_id, other links it has here, least vec_id of its part here)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "tile"):
            if table.num_rows < 2:
                continue
            table = table.sort_by("guest")  # those that are at home along all axes come first
            b, w = int(table["block"][0].as_py()), int(table["width"][0].as_py())
            cross, part, guest = bool(table["cross"][0].as_py()), table["part"].to_numpy(), table["guest"].to_numpy()
            names, copies = table["vec_id"].to_numpy(), table["copies"].to_numpy()
            n, host = len(names), int((guest < guest.max()).sum()) if guest.max() else len(names)
            unit = _unit(_vectors(table["vector"]))
            turned, spans, budgets = unit @ rotation(w), edges_of(w), _budgets(w, cosine)
            x, y = spans[b]
            # |p - q|^2 <= budget as one product: p.q - |p|^2/2 - |q|^2/2 >= -budget/2, in single precision with room.
            own = turned[:, x:y].astype(np.float32)
            half = (own * own).sum(axis=1, keepdims=True) / 2
            one = np.ones_like(half)
            left, right = np.hstack([own, -half, one]), np.hstack([own, one, -half])
            least_product = np.float32(-(budgets[b] + 10 * ROUNDING) / 2)
            none = np.zeros(0, np.int64)
            counts, us, vs = np.zeros(n, np.int64), [none], [none]
            step = max(1, 2_000_000 // n)
            for lo in range(0, host, step):
                hi = min(host, lo + step)
                near = np.flatnonzero(left[lo:hi] @ right[lo:].T >= least_product)
                for at in range(0, len(near), 500_000):
                    p, q = np.divmod(near[at : at + 500_000], n - lo)
                    p, q = p + lo, q + lo
                    fit = (p < q) & (guest[p] & guest[q] == 0)
                    if cross:
                        fit &= part[p] != part[q]
                    p, q = p[fit], q[fit]
                    gap = turned[p] - turned[q]
                    for k, (begin, end) in enumerate(spans[: b + 1]):  # the first block within its budget takes the pair
                        inside = (gap[:, begin:end] ** 2).sum(axis=1) <= budgets[k] + ROUNDING
                        fit = inside if k == b else ~inside
                        p, q, gap = p[fit], q[fit], gap[fit]
                    true = (unit[p] * unit[q]).sum(axis=1) >= cosine
                    p, q = p[true], q[true]
                    counts += np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
                    star = local_components(n, p, q)  # a spanning forest of these links
                    linked = np.flatnonzero(star != np.arange(n))
                    us.append(linked)
                    vs.append(star[linked])
            label = local_components(n, np.concatenate(us), np.concatenate(vs))
            least = np.full(n, np.iinfo(np.int64).max)
            np.minimum.at(least, label, names)
            linked = counts > 0
            yield pa.RecordBatch.from_arrays([pa.array(names[linked]), pa.array(counts[linked]), pa.array(least[label][linked])], ["vec_id", "links", "least"])

    return link


def near_vectors(vectors: DataFrame, cosine: float = 0.93, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; pairs are compared only if their labels are equal.

    Null, empty and zero vectors, those with null or non-finite components and those without a label or id are linked
    with nothing (a null id is not kept); so are vectors of different width.  Equal vectors of one label are one node that
    counts for all its rows.  Repeated rows of one id count as vectors of their own.  An empty table gives no rows; other
    columns are not read, so their names can't clash.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2000)
    narrow = vectors.schema[vector].dataType.simpleString() in ("array<float>", "array<double>")  # vectors travel as narrow as they come
    raw = F.col(vector) if narrow else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), raw.alias("vector"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.size("vector") > 0, F.lit(False))
    sound &= F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    content = F.concat_ws(",", F.transform("vector", lambda x: (x + F.lit(0.0)).cast("string")))
    rows = rows.withColumn("node", F.when(F.coalesce(sound, F.lit(False)), F.unhex(F.sha2(F.concat_ws("|", "label", content), 256))))
    thin = keep(rows.select("vec_id", "node"), "vector-keys")
    same = keep(thin.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "same-vectors")
    firsts = rows.filter("node is not null").join(same, ["node", "vec_id"]).dropDuplicates(["node"])
    nodes = keep(firsts.select("vec_id", "label", F.size("vector").alias("width"), "copies", "vector"), "vectors")
    # A label with more vectors than its fullest cell may have gets more axes.
    axes = F.ceil(F.log(F.col("n") * SUBCELL_SHARE / TILE_ROWS) / F.log(F.lit(1 / SUBCELL_SHARE))) + 1
    labels = nodes.groupBy("label", "width").agg(F.count("*").alias("n"))
    labels = keep(labels.withColumn("axes", F.least(F.lit(MOST_AXES), axes).cast("int")).filter("axes > 1"), "large-labels")
    few = labels.count() <= SMALL_ROWS
    split = nodes.join(F.broadcast(labels), ["label", "width"], "left") if few else meet(nodes, labels, ["label", "width"], "n", "left")
    split = split.withColumn("axes", F.coalesce("axes", F.lit(1))).drop("n")
    # Cells that are still large are cut into parts, and each pair of parts is a tile.
    key = ["label", "width", "block", "cell"]
    large = keep(split.mapInArrow(_deal(cosine, True), _CELL).groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > TILE_ROWS), "large-cells")
    few = large.count() <= SMALL_ROWS
    dealt = split.mapInArrow(_deal(cosine, False), f"{_CELL}, vec_id long, copies long, vector {nodes.schema['vector'].dataType.simpleString()}")
    tiled = dealt.join(F.broadcast(large), key, "left") if few else meet(dealt, large, key, "n", "left")
    parts = F.coalesce(F.ceil(F.col("n") / TILE_ROWS).cast("int"), F.lit(1))
    tiled = tiled.withColumn("t", parts).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("t")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    tiled = tiled.select(F.xxhash64(*key, low, high).alias("tile"), (low != high).alias("cross"), "part", "width", "block", "guest", "vec_id", "copies", "vector")
    found = keep(tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(_link(cosine), "vec_id long, links long, least long"), "links")
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("vec_id").alias("u"), F.col("least").alias("v"))).withColumnRenamed("node", "vec_id")
    of_node = same.join(counts, "vec_id", "left").join(groups, "vec_id", "left")
    of_node = of_node.select("node", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "vec_id").alias("component"))
    out = meet(thin, keep(of_node, "vector-groups"), ["node"], "copies", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT DISTINCT u AS node, u AS root FROM links UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT embeddings.vec_id, coalesce(counts.n, 0) AS n_links, coalesce(comp.root, embeddings.vec_id) AS component_id,
       embeddings.vec_id = coalesce(comp.root, embeddings.vec_id) AS kept
FROM embeddings LEFT JOIN counts ON counts.u = embeddings.vec_id LEFT JOIN comp ON comp.node = embeddings.vec_id
"""
