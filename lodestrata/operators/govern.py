"""Governance as data: row and mask policies, metadata search, lineage, tags, figure checks and request states."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PATCH = 1000
#: Figures in the result tables of one report: pages of at most 500 rows.
MAX_CELLS = 20_000
MAX_CLAIMS = 2_000


def rows_for(rows: DataFrame, policy: Column) -> DataFrame:
    """Rows whose policy is true; null hides them."""
    return rows.filter(policy)


def rows_by_map(rows: DataFrame, allowed: DataFrame, user: str, column: str) -> DataFrame:
    """Rows whose value is allowed to the user by a mapping table (user, value); '*' allows all."""
    own = allowed.filter(F.col("user") == user).select("value").distinct()
    every = own.filter("value = '*'").limit(1).select(F.lit(True).alias("_all"))
    seen = rows.join(own, rows[column].cast("string") == own["value"], "left_semi")
    return seen if not every.count() else rows


def mask_by(rows: DataFrame, masks: dict[str, str]) -> DataFrame:
    """Columns replaced by SQL expressions, which must have the column's own type."""
    for name, expression in masks.items():
        kind, new = rows.schema[name].dataType, rows.select(F.expr(expression).alias("x")).schema["x"].dataType
        if kind != new:
            raise ValueError(f"the mask of {name} gives {new.simpleString()}, not {kind.simpleString()}")
    return rows.withColumns({n: F.expr(e) for n, e in masks.items()})


class Governed:
    """A view with policies; readers get the view only."""

    def __init__(self, rows: DataFrame, name: str):
        self.rows, self.name, self.policy, self.masks = rows, name, None, {}

    def set_rows(self, policy: Column | None) -> Governed:
        self.policy = policy
        return self

    def set_mask(self, column: str, expression: str | None) -> Governed:
        if expression is None:
            self.masks.pop(column, None)
        else:
            mask_by(self.rows, {column: expression})
            self.masks[column] = expression
        return self

    def view(self) -> DataFrame:
        rows = self.rows if self.policy is None else rows_for(self.rows, self.policy)
        mask_by(rows, self.masks).createOrReplaceTempView(self.name)
        return rows.sparkSession.table(self.name)


# Metadata


def search(assets: DataFrame, key: str, fields: list[str], words: str) -> DataFrame:
    """Assets in whose fields each keyword begins some word; '*' finds all.  A test of each row alone, without a shuffle."""
    if words.strip() == "*":
        return assets.select(key)
    wanted = sorted({w.lower() for w in words.split()})
    text = F.lower(F.concat_ws(" ", *[F.col(f).cast("string") for f in fields]))
    found = F.split(text, r"[^\p{L}\p{N}]+")
    begins = lambda w: F.exists(found, lambda word: F.startswith(word, F.lit(w)))
    every = reduce(Column.__and__, [F.contains(text, F.lit(w)) for w in wanted])  # cheap, and true of all hits
    return assets.filter(every & reduce(Column.__and__, [begins(w) for w in wanted])).select(key).distinct()


def browse(assets: DataFrame, path: str, under: str) -> DataFrame:
    """The next level below a path: ``name, n`` with the number of assets in each branch."""
    depth = len([p for p in under.split("/") if p])
    rows = assets.filter(F.startswith(path, F.lit(under))) if under else assets
    return rows.groupBy(F.split(path, "/")[depth].alias("name")).agg(F.count("*").alias("n"))


#: Jumps may be so many times as many as edges; beyond that they aren't lengthened further.
MOST_JUMPS = 4


def closure(edges: DataFrame, start: DataFrame, keep) -> DataFrame:
    """``node, step``: everything reached from ``start`` over (src, dst) with the least number of steps, whatever the depth.

    Path doubling: jumps of 1, 2, 4, ... edges.  When all nodes of fewer than 2^k steps are known, their jumps of 2^k edges
    give those of fewer than 2^(k+1), so that the rounds grow with the logarithm of the depth.  Cycles end, as each node is
    taken once.  Where paths branch and meet so often that longer jumps would outgrow the edges ``MOST_JUMPS`` times, jumps
    stay as long as they are, and each round goes on from the nodes that the last one found.  A round writes only the new
    nodes and jumps.
    """
    jumps = keep(edges.select("src", "dst").filter("src is not null and dst is not null").distinct())
    most, length = MOST_JUMPS * jumps.count(), 1
    found = [keep(start.select("node", F.lit(0).cast("long").alias("step")).distinct())]
    doubling = True
    while True:
        seen = reduce(DataFrame.union, found)
        front = seen if doubling else found[-1]
        reached = front.withColumnRenamed("node", "src").join(jumps, "src").groupBy(F.col("dst").alias("node")).agg((F.min("step") + length).alias("step"))
        new = keep(reached.join(seen, "node", "left_anti"))
        if new.isEmpty():
            return seen.withColumn("step", F.col("step").cast("int"))
        found.append(new)
        if doubling:
            longer = keep(jumps.join(jumps.select(F.col("src").alias("dst"), F.col("dst").alias("end")), "dst").select("src", F.col("end").alias("dst")).distinct())
            n = longer.count()
            if not n:
                return reduce(DataFrame.union, found).withColumn("step", F.col("step").cast("int"))
            doubling = n <= most
            if doubling:
                jumps, length = longer, 2 * length


def patch_lineage(edges: DataFrame, add: DataFrame, remove: DataFrame, dry_run: bool = False) -> DataFrame:
    """Edges (src, dst, origin) with manual edges added and removed; repeats change nothing, automatic edges stay.

    A dry run returns ``change, src, dst`` instead.
    """
    for what in (add, remove):
        if what.limit(MAX_PATCH + 1).count() > MAX_PATCH:
            raise ValueError(f"at most {MAX_PATCH} edges a call")
    key = ["src", "dst"]
    gone = edges.filter("origin = 'manual'").join(remove.select(*key).distinct(), key, "left_semi")
    new = add.select(*key).distinct().join(edges, key, "left_anti").withColumn("origin", F.lit("manual"))
    if dry_run:
        return gone.select(F.lit("remove").alias("change"), *key).union(new.select(F.lit("add").alias("change"), *key))
    return edges.join(gone, [*key, "origin"], "left_anti").select(*key, "origin").union(new.select(*key, "origin"))


def tagged(assets: DataFrame, tags: DataFrame, key: str, tag: str) -> DataFrame:
    return assets.join(tags.filter(F.col("tag") == tag).select(key).distinct(), key, "left_semi")


def drop_tag(tags: DataFrame, tag: str) -> DataFrame:
    return tags.filter(F.col("tag") != tag)


def verify_figures(claims: DataFrame, cells: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """``claim_id, status``: verified if a cell has the figure, derived if a sum, difference or ratio of two cells has.

    ``claims`` (claim_id, figure) and ``cells`` (cell, amount) are the figures of one report and its result tables.
    Figures meet cells by rounded value, not pair by pair.  Over ``MAX_CELLS`` cells or ``MAX_CLAIMS`` claims are refused: they are no report's.
    """
    for rows, most, what in ((cells, MAX_CELLS, "cells"), (claims, MAX_CLAIMS, "claims")):
        if rows.limit(most + 1).count() > most:
            raise ValueError(f"more than {most} {what}, where a report has at most that many")
    near = lambda a, b: F.abs(a - b) <= tolerance
    grid = lambda c: F.floor(c / tolerance).cast("long")
    spread = claims.select("claim_id", "figure", F.explode(F.array(grid(F.col("figure")) - 1, grid(F.col("figure")), grid(F.col("figure")) + 1)).alias("g"))
    direct = spread.join(cells.select("amount", grid(F.col("amount")).alias("g")).distinct(), "g").filter(near(F.col("figure"), F.col("amount"))).select("claim_id").distinct()
    # For a claim f and a cell a, the partner is f - a (sum), a - f (difference) or a / f (ratio).
    left = claims.join(direct, "claim_id", "left_anti").crossJoin(F.broadcast(cells.select("cell", "amount")))  # counted above
    partner = F.explode(F.array(F.col("figure") - F.col("amount"), F.col("amount") - F.col("figure"), F.try_divide("amount", "figure"))).alias("partner")
    tried = left.select("claim_id", "cell", partner).filter("partner is not null")
    tried = tried.select("claim_id", "cell", "partner", F.explode(F.array(grid(F.col("partner")) - 1, grid(F.col("partner")), grid(F.col("partner")) + 1)).alias("g"))
    other = cells.select(F.col("cell").alias("cell2"), F.col("amount").alias("amount2"), grid(F.col("amount")).alias("g"))
    derived = tried.join(other, "g").filter(near(F.col("partner"), F.col("amount2")) & (F.col("cell") != F.col("cell2"))).select("claim_id").distinct()
    marks = direct.withColumn("status", F.lit("verified")).union(derived.withColumn("status", F.lit("derived")))
    return claims.select("claim_id").join(marks, "claim_id", "left").select("claim_id", F.coalesce("status", F.lit("unverified")).alias("status"))


def request_states(log: DataFrame, allowed: list[tuple[str | None, str]], start: str = "draft") -> DataFrame:
    """``request_id, state, n_rejected``: the state after the last valid event of each request.

    ``log`` has request_id, seq, state and actor.  An event is valid if it may follow the event before it; approval by the
    one who submitted is not.
    """
    w = Window.partitionBy("request_id").orderBy("seq")
    before = F.coalesce(F.lag("state").over(w), F.lit(start))
    submitter = F.last(F.when(F.col("state") == "submitted", F.col("actor")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    pair = reduce(Column.__or__, [(F.col("_before") == a) & (F.col("state") == b) for a, b in allowed])
    marked = log.withColumn("_before", before).withColumn("_submitter", submitter)
    valid = pair & ~F.coalesce((F.col("state") == "approved") & (F.col("actor") == F.col("_submitter")), F.lit(False))
    marked = marked.withColumn("_valid", valid)
    last = F.max_by(F.when(F.col("_valid"), F.col("state")), F.when(F.col("_valid"), F.col("seq")))
    return marked.groupBy("request_id").agg(F.coalesce(last, F.lit(start)).alias("state"), F.count_if(~F.col("_valid")).alias("n_rejected"))
