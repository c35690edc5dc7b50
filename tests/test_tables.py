"""Properties and refusals of versioned tables, ingestion, modelling, quality and governance."""

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import scalar as S
from lodestrata.operators import copies as K
from lodestrata.operators import govern as G
from lodestrata.operators import quality as Q
from lodestrata.operators import tables as T
from lodestrata.operators import vault as V
from lodestrata.shared import new_path
from lodestrata.sources import files as R
from lodestrata.sources import ingest as I

DAY = [f"2024-01-0{i} 00:00:00" for i in range(1, 8)]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture()
def log(spark):
    return T.ChangeLog.create(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string"), ["k"], DAY[0])


def test_versions_and_rollback(spark, log):
    log.update(F.col("k") == 1, {"v": F.lit("z")}, DAY[1])
    log.delete(F.col("k") == 2, DAY[2])
    log.merge(spark.createDataFrame([(2, "again"), (9, "new")], "k int, v string"), DAY[3])
    assert rows_of(log.read()) == [(1, "z"), (2, "again"), (3, None), (9, "new")]
    log.rollback(2, DAY[4])
    assert rows_of(log.read()) == rows_of(log.read(2)) == [(1, "z"), (2, "b"), (3, None)]
    assert rows_of(log.read_at("2024-01-03 12:00:00")) == [(1, "z"), (3, None)]
    assert [r["operation"] for r in log.history().collect()] == ["CREATE", "UPDATE", "DELETE", "MERGE", "ROLLBACK"]
    log.expire(5, DAY[5])
    assert rows_of(log.read()) == rows_of(log.read(5))
    with pytest.raises(ValueError):
        log.read_at("2020-01-01 00:00:00")


def test_expiring_an_older_version_loses_nothing(spark, log):
    log.update(F.col("k") == 1, {"v": F.lit("z")}, DAY[1])
    log.delete(F.col("k") == 2, DAY[2])
    want = {v: rows_of(log.read(v)) for v in (2, 3)}
    log.expire(2, DAY[3])
    assert rows_of(log.read()) == want[3] and all(rows_of(log.read(v)) == want[v] for v in want)
    with pytest.raises(ValueError, match="expired"):
        log.read(1)
    assert T.orphans(spark, log, "2100-01-01").count() == 0
    log.merge(spark.createDataFrame([(5, "e")], "k int, v string"), DAY[4])
    log.truncate(DAY[5])
    assert log.read().count() == 0 and rows_of(log.read(5)) == sorted([*want[3], (5, "e")], key=str)
    assert log.expire_older(DAY[5], DAY[6], retain_last=2) is not None and log.read().count() == 0 and rows_of(log.read(5)) == sorted([*want[3], (5, "e")], key=str)
    with pytest.raises(ValueError):
        log.read(3)


def test_racing_writers_lose_no_update(spark, log):
    """A second writer commits while the first one is writing; the first starts again from what it finds."""
    other, seen = T.ChangeLog(spark, log.path, log.key, log.schema), []
    read = log.read

    def late(version=None):
        rows = read(version)
        if not seen:
            seen.append(1)
            other.update(F.col("k") == 1, {"v": F.lit("other")}, DAY[1])
        return rows

    log.read = late
    log.update(F.col("k") > 0, {"v": F.concat(F.coalesce("v", F.lit("")), F.lit("!"))}, DAY[2])
    assert rows_of(read()) == [(1, "other!"), (2, "b!"), (3, "!")]
    assert [r["version"] for r in other.history().collect()] == [1, 2, 3]


def test_files_of_one_second_are_all_read(spark):
    path, seen, mark = new_path(spark, "files"), [], None
    for i in range(4):
        spark.range(i * 10, i * 10 + 3).coalesce(1).write.mode("append").parquet(path)
        rows, mark = R.read_modified_after(spark, path, mark)
        seen += [r["id"] for r in rows.collect()]
    assert sorted(seen) == [i * 10 + j for i in range(4) for j in range(3)] and R.read_modified_after(spark, path, mark)[0] is None


def test_values_with_many_rows_fill_several_files(spark):
    rows = spark.range(1000).withColumn("flag", F.when(F.col("id") < 900, "A").otherwise("B"))
    dealt = T.spread(rows, ["flag"], rows_a_file=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would go to one task
    try:
        assert dealt.select("flag", F.spark_partition_id().alias("p")).filter("flag = 'A'").select("p").distinct().count() > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dealt.count() == 1000 and dealt.columns == rows.columns


def test_merge_refuses_repeated_keys(spark, log):
    with pytest.raises(ValueError, match="several rows"):
        log.merge(spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), DAY[1])


def test_uncommitted_rows_are_not_read(spark, log):
    spark.createDataFrame([(7, "torn", "I")], "k int, v string, _op string").write.parquet(f"{log.path}/rows/_version=2")
    assert log.read().count() == 3
    log.delete(F.col("k") == 1, DAY[1])
    assert rows_of(log.read()) == [(2, "b"), (3, None)]


def test_columns(spark):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    assert T.alter_column(rows, "k", new_type="bigint").schema["k"].dataType.simpleString() == "bigint"
    for call in (lambda: T.alter_column(rows, "k", new_type="smallint"), lambda: T.alter_column(rows.withColumn("d", F.lit(1).cast("decimal(10,2)")), "d", new_type="decimal(10,4)"), lambda: T.drop_columns(rows, "x"), lambda: T.partition_transform("k", "weekly")):
        with pytest.raises(ValueError):
            call()


def test_changes_in_batches_are_changes_at_once(spark):
    log = spark.createDataFrame([(1, 1, "c"), (1, 2, "d"), (2, 3, "c"), (1, 4, "u"), (2, 5, "d")], "k int, seq int, op string")
    once = I.apply_changes(None, log, ["k"], ["seq"], hard=False)
    part = I.apply_changes(None, log.filter("seq <= 2"), ["k"], ["seq"], hard=False)
    assert rows_of(I.apply_changes(part, log.filter("seq > 2"), ["k"], ["seq"], hard=False)) == rows_of(once)
    assert rows_of(I.apply_changes(None, log, ["k"], ["seq"], hard=True)) == [(1, 4)]


def test_decimals_are_not_rounded(spark):
    text = spark.createDataFrame([("1.5",), ("0.123456789",), (None,), ("2.5000000000",)], "t string")
    assert [str(r[0]) for r in text.select(I.exact_decimal(F.col("t"))).collect()][1] == "0.123456789"
    for bad in ("0.1234567891", "123456789012345678901234567890.5"):
        with pytest.raises(Exception, match="doesn't fit"):
            spark.createDataFrame([(bad,)], "t string").select(I.exact_decimal(F.col("t"))).collect()


def test_state(spark):
    state = I.State(spark, new_path(spark, "state"))
    assert state.position("f", "t") is None
    for i in range(12):
        state.save("f", [("t", str(i), {"cursor": "a"}, 1)])
    assert state.kept().count() == 10
    assert state.position("f", "t", {"cursor": "a"}) == "11" and state.position("f", "t", {"cursor": "b"}) is None
    assert I.changed_tables(state, "f", {"t": {"cursor": "b"}, "u": {}}) == ["t"]


def test_satellite_keeps_returns(spark):
    """A, B, A gives three rows, in one load or in two."""
    rows = spark.createDataFrame([(1, "A", 1, 1), (1, "A", 2, 2), (1, "B", 3, 3), (1, "A", 4, 4)], "k int, a string, ts int, seq int")
    whole = V.satellite(None, rows, "k", ["a"], "ts", "seq")
    assert [r["a"] for r in whole.orderBy("ts").collect()] == ["A", "B", "A"]
    first = V.satellite(None, rows.filter("ts <= 2"), "k", ["a"], "ts", "seq")
    assert rows_of(first.union(V.satellite(first, rows, "k", ["a"], "ts", "seq"))) == rows_of(whole)


def test_scd2_delta(spark):
    stored = spark.createDataFrame([(1, "a", 1, None, True), (2, "b", 1, None, True)], "k int, v string, effective_date int, expiry_date int, is_current boolean")
    out = V.scd2_apply(stored, spark.createDataFrame([(1, "z"), (2, "b"), (3, "n")], "k int, v string"), ["k"], ["v"], F.lit(5))
    assert rows_of(out) == [(1, "a", 1, 5, False), (1, "z", 5, None, True), (2, "b", 1, None, True), (3, "n", 5, None, True)]
    assert Q.one_current(out, ["k"]).first()["passed"] and Q.no_overlap(out, ["k"], "effective_date", "expiry_date").first()["passed"]


def test_split_keeps_all_rows(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, None), (3, 9.0)], "k int, v double")
    kept, dropped = Q.split(rows, {"big": ("v > 5", "drop"), "named": ("k < 3", "warn")})
    assert [r["k"] for r in kept.collect()] == [3] and sorted(r["k"] for r in dropped.collect()) == [1, 2]
    with pytest.raises(ValueError, match="only warn"):
        Q.split(rows, {"u": ("unique(k)", "drop")})


def test_copies(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], "d string, e string, v int")
    copy = K.AggregateCopy.build(rows, new_path(spark, "copy"), ["d", "e"], ["v"], 1)
    spec = {"dimensions": ["d"], "measures": [("sum", "v"), ("avg", "v"), ("count", None)]}
    got, used = K.answer(rows, spec, [copy])
    assert used is copy and rows_of(got) == rows_of(K.answer(rows, spec, [])[0])
    for other in ({"dimensions": ["f"], "measures": []}, {"dimensions": ["d"], "measures": [("sum", "w")]}, {"dimensions": ["d"], "measures": [("cardinality", "v")]}):
        assert not copy.covers(other)


def test_sketches_answer_approximate_counts_only(spark):
    """Rolled-up sketches estimate what one over the base does, nulls left out; exact counts go to the base."""
    rows = spark.range(4000).selectExpr("id % 3 as d", "id % 5 as e", "if(id % 10 = 0, null, id % 1500) as v")
    copy = K.AggregateCopy.build(rows.filter("d < 2"), new_path(spark, "copy"), ["d", "e"], [], 1, ["v"])
    copy.refresh(rows.filter("d = 2"), 2)
    spec = {"dimensions": ["d"], "measures": [("approx_cardinality", "v")]}
    got, used = K.answer(rows, spec, [copy])
    exact = dict(rows.groupBy("d").agg(F.count_distinct("v")).collect())
    assert used is copy and all(abs(n - exact[d]) <= 0.05 * exact[d] for d, n in got.collect()) and got.count() == 3
    base, used = K.answer(rows, spec, [])
    assert used is None and all(abs(n - exact[d]) <= 0.05 * exact[d] for d, n in base.collect())
    assert K.answer(rows, {"dimensions": ["d"], "measures": [("cardinality", "v")]}, [copy])[1] is None


def test_policies(spark):
    rows = spark.createDataFrame([("a", 1)], "n string, k int")
    with pytest.raises(ValueError, match="mask"):
        G.mask_by(rows, {"n": "1"})
    edges = spark.createDataFrame([("a", "b", "automatic"), ("b", "c", "manual")], "src string, dst string, origin string")
    gone = G.patch_lineage(edges, edges.limit(0), edges)
    assert rows_of(gone) == [("a", "b", "automatic")]
    assert rows_of(G.patch_lineage(edges, edges, edges.limit(0))) == rows_of(edges)
    with pytest.raises(ValueError, match="1000"):
        G.patch_lineage(edges, spark.range(1001).selectExpr("cast(id as string) src", "'x' dst"), edges.limit(0))
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    from lodestrata.shared import keep

    assert rows_of(G.closure(loop, spark.createDataFrame([("a",)], "node string"), keep)) == [("a", 0), ("b", 1)]


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("junk line\n1|x\n# note\n2|'y|z'\n")
    got = R.read_delimited(spark, str(tmp_path / "a.csv"), "k int, v string", delimiter="|", quote="'", comment="#", header=False, skip_first_line=True)
    assert rows_of(got) == [(1, "x"), (2, "y|z")]
    (tmp_path / "b.json").write_text('[{"k": 1}, {"k": 2}]')
    assert rows_of(R.read_json(spark, str(tmp_path / "b.json"), "k int", arrays=True)) == [(1,), (2,)]
    assert rows_of(S.flatten(spark.createDataFrame([(1, ["a"]), (2, [])], "k int, l array<string>"), "l", "x", keep_empty=True).drop("l")) == [(1, "a"), (2, None)]
