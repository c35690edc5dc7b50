"""Closures by path doubling, profiles by sketches, and files that are read once."""

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import govern as G
from lodestrata.operators import quality as Q
from lodestrata.shared import keep, new_path
from lodestrata.sources import files as R


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def breadth_first(edges, start):
    steps, front = {n: 0 for n in start}, list(start)
    while front:
        front = sorted({d for s, d in edges if s in front and d not in steps})
        steps |= {n: max(steps.values()) + 1 for n in front}
    return sorted(steps.items(), key=str)


@pytest.mark.parametrize("most", [4, 1, 0])
def test_closure(spark, monkeypatch, most):
    """Random graphs with cycles, a ladder, an unknown start; with few jumps allowed the front goes on by fixed ones."""
    monkeypatch.setattr(G, "MOST_JUMPS", most)
    r = random.Random(most)
    graphs = [[(r.randrange(30), r.randrange(30)) for _ in range(45)], [(i, j) for k in range(0, 24, 2) for i in (k, k + 1) for j in (k + 2, k + 3)], [(i, (i + 1) % 13) for i in range(13)]]
    for edges in graphs:
        found = G.closure(spark.createDataFrame([*edges, *edges[:3], (None, 1), (1, None)], "src int, dst int"), spark.createDataFrame([(0,), (0,), (99,)], "node int"), keep)
        assert rows_of(found) == breadth_first(edges, [0, 99])
    assert rows_of(G.closure(spark.createDataFrame([], "src int, dst int"), spark.createDataFrame([(5,)], "node int"), keep)) == [(5, 0)]


def test_a_chain_of_100000_edges(spark):
    written = []

    def count(frame):
        written.append(1)
        return keep(frame)

    chain = spark.range(100_000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = G.closure(chain, spark.createDataFrame([(0,)], "node long"), count)
    assert found.agg(F.count("*"), F.min(F.col("node") == F.col("step")), F.max("step")).first()[:] == (100_001, True, 100_000)
    assert len(written) < 2 * 20  # nodes and jumps of each round


def test_profile(spark):
    """Exact results from sketches: few and many values, nulls, empty text, zeros of both signs."""
    n = 9000
    rows = spark.range(n).select(
        "id", (F.col("id") % 5000).alias("half"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("some"), F.concat(F.lit("x"), "id").alias("name"), F.lit("").alias("empty"),
        F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("zero"), F.lit(None).cast("date").alias("none"), (F.col("id") / 2).cast("decimal(12,1)").alias("money"),
    )
    got = {r["column"]: (r["n_rows"], r["n_nulls"], r["n_distinct"], r["is_key"]) for r in Q.profile(rows).collect()}
    want = rows.agg(*[F.count_distinct(c).alias(c) for c in rows.columns]).first().asDict()
    assert {c: g[2] for c, g in got.items()} == want | {"zero": 1}
    assert got["id"] == (n, 0, n, True) and got["name"][3] and got["money"][3] and not got["half"][3] and got["none"] == (n, n, 0, False) and got["some"][1] == n // 3
    plan = Q.sketches(rows, rows.columns)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert {r["column"]: r["is_key"] for r in Q.profile(rows, every=False).collect()} == {c: g[3] for c, g in got.items()}
    assert rows_of(Q.profile(spark.createDataFrame([], "a int")).select("n_rows", "n_distinct")) == [(0, 0)]


def test_automap_on_large_columns(spark):
    """References over sketches that don't hold all values; one missing value in 20,000 rules a reference out."""
    keys = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("small"))
    good = spark.range(40_000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 19_000).alias("ref"), F.lit("t").alias("text"))
    bad = spark.range(20_000).select(F.when(F.col("id") == 7, 20_001).otherwise(F.col("id")).alias("ref"))
    tables = {"keys": keys, "good": good, "bad": bad, "none": spark.createDataFrame([], "ref long"), "text": spark.createDataFrame([("a",)], "t string")}
    want = lambda *more: sorted([("good", "ref", "keys", "k"), ("keys", "small", "bad", "ref"), *more])
    found = [tuple(r)[:4] for r in Q.automap(tables).collect()]
    assert sorted(found) == want() or sorted(f for f in found if f[1] != "small") == [("good", "ref", "keys", "k")]
    loose = {tuple(r)[:4] for r in Q.automap(tables, threshold=0.99).collect()}
    assert {("good", "ref", "keys", "k"), ("bad", "ref", "keys", "k")} <= loose
    assert Q.automap({"text": tables["text"]}).count() == 0


def test_files_of_one_second_are_read_once(spark):
    """Files that come between the calls, older ones too, are each read by one call."""
    import os

    path, checkpoint, seen = new_path(spark, "files"), new_path(spark, "checkpoint"), []
    for i in range(4):
        spark.range(i * 10, i * 10 + 3).coalesce(1).write.mode("append").parquet(f"{path}/d{i}")
        if i == 2:  # much older than what has been read
            for f in os.listdir(f"{path}/d2".removeprefix("file:")):
                os.utime(f"{path}/d2/{f}".removeprefix("file:"), (1e9, 1e9))
        got = [r["id"] for r in R.read_new_files(spark, path, "id long", checkpoint).collect()]
        assert sorted(got) == [i * 10 + j for j in range(3)]
        seen += got
    assert R.read_new_files(spark, path, "id long", checkpoint).count() == 0 and len(seen) == 12
