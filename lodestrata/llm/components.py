"""Connected components by alternating large-star and small-star steps (Kiveris and others, 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, keep, meet, tidy


def _least(edges: DataFrame) -> DataFrame:
    """``u, m, n``: the least neighbour of each node and the number of its rows; combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Join each node's larger neighbours to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"), "n")
    return meet(both.filter("v > u"), least, ["u"], "n", total=2 * total).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Edges lead from larger to smaller nodes: join each node and its smaller neighbours to the least of these."""
    least = _least(edges)
    moved = meet(edges, least, ["u"], "n", total=total).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the undirected ``edges`` (u, v); the component is its least node.

    Each round is written to the shared folder and read back, which cuts the lineage.  A round that leaves the edges as
    they were ends it; the stars that remain are the components.  A node with a great part of all edges is met by
    broadcasting its least neighbour, so that its edges stay where they are.  Self-edges and null ends are ignored.
    """
    oriented = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = keep(oriented.distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not mark[0]:
            break
        seen = mark
        after = keep(_small_star(_large_star(now, mark[0]).distinct(), mark[0]).filter("u <> v").distinct(), "edges")
        discard(now)
        now = after
        tidy(edges.sparkSession)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key of a partition that is sorted by it; a key's rows may lie in several batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(begin, end - begin)
            if held and held[-1][key][0].as_py() != keys[begin]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def parts_of(count, most: int, weight=None, most_weight: int = 1):
    """Into how many parts a group of ``count`` members, or of that weight, is cut."""
    parts = F.greatest(F.lit(1), F.ceil(count / F.lit(most)).cast("int"))
    return parts if weight is None else F.greatest(parts, F.ceil(weight / F.lit(most_weight)).cast("int"))


def pivot_tiles(members: DataFrame, key: str, node: str) -> DataFrame:
    """Each member once, in a tile ``tile`` of its key; the key's pivot is in all of the key's tiles.

    ``members`` has key, node, ``t`` (parts of the key) and ``pivot``, one of its nodes.  What is compared in the tiles
    connects a tight group by its pivot, so that only ``stray_tiles`` of those that aren't need more.
    """
    own = F.pmod(F.xxhash64(node), F.col("t")).cast("int")
    rest = members.filter(f"{node} <> pivot").select(F.xxhash64(key, own).alias("tile"), node)
    pivots = members.filter(f"{node} = pivot").select(key, node, F.explode(F.sequence(F.lit(0), F.col("t") - 1)).alias("_i"))
    return rest.union(pivots.select(F.xxhash64(key, "_i").alias("tile"), node))


def stray_tiles(members: DataFrame, links: DataFrame, key: str, node: str, most: int) -> DataFrame:
    """Tiles in which the members that no link joins to their pivot meet all members of their key.

    Only keys of several parts have any.  ``links`` (u, v) lead from members to the least ones of what they were linked
    to.  With r strays a key's members are repeated r / ``most`` times, rounded up, and the strays once for each part.
    """
    cut = members.filter("t > 1")
    linked = links.select(F.col("u").alias(node), F.col("v").alias("pivot")).distinct()
    stray = keep(cut.filter(f"{node} <> pivot").join(linked, [node, "pivot"], "left_anti"), "strays")
    counts = keep(stray.groupBy(key).agg(F.count("*").alias("_r"), F.first("t").alias("_t")).withColumn("_parts", parts_of(F.col("_r"), most)), "stray-counts")
    lone = meet(stray.select(key, node, "t"), counts.select(key, "_r", "_parts"), [key], "_r")
    mine = F.pmod(F.xxhash64(node, F.lit(1)), F.col("_parts")).cast("int")
    lone = lone.select(key, node, mine.alias("_i"), F.explode(F.sequence(F.lit(0), F.col("t") - 1)).alias("_j"))
    sizes = counts.join(cut.groupBy(key).agg(F.count("*").alias("_n")), key)
    every = meet(cut.select(key, node, "t"), sizes.select(key, "_parts", "_n"), [key], "_n")
    every = every.select(key, node, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_i"), F.pmod(F.xxhash64(node), F.col("t")).cast("int").alias("_j"))
    return lone.union(every).select(F.xxhash64(key, F.lit(-1), "_i", "_j").alias("tile"), node).distinct()
