"""Change streams in any order, streams with keyed state, and writers that die or race."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import tables as T
from lodestrata.shared import create_once, keep, new_path
from lodestrata.sources import ingest as I
from lodestrata.streaming import flows as Z

LOG = "k int, ts int, seq int, v string, op string"
ORDER = ["ts", "seq"]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def random_log(n, seed):
    r = random.Random(seed)
    return [(r.choice([None, 1, 2, 3, 4]), r.randrange(30), r.randrange(3), r.choice([None, "a", "b", "c"]), r.choice("cuud")) for i in range(n)]


def in_batches(spark, rows, hard, seed, since=()):
    random.Random(seed).shuffle(rows)
    target, cuts = None, [0, *sorted(random.Random(seed).sample(range(1, len(rows)), 3)), len(rows)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        target = keep(I.merge_changes(target, spark.createDataFrame(rows[lo:hi], LOG), ["k"], ORDER, hard), "target")
    return target


@pytest.mark.parametrize("hard", [True, False])
def test_changes_in_any_batches(spark, hard):
    for seed in range(3):
        rows = random_log(40, seed)
        rows += rows[:5]  # changes that come again
        once = I.merge_changes(None, spark.createDataFrame(rows, LOG), ["k"], ORDER, hard)
        want = {}
        for k, ts, seq, _, op in rows:
            want[k] = max(want.get(k, (-1, -1, "")), (ts, seq, op))
        assert {r["k"]: (r["ts"], r["seq"], r["_op_type"]) for r in once.collect()} == want
        assert rows_of(in_batches(spark, rows, hard, seed)) == rows_of(once)


def test_a_late_update_revives_nothing(spark):
    at = lambda *rows: spark.createDataFrame(list(rows), LOG)
    target = keep(I.merge_changes(None, at((1, 5, 0, "a", "c"), (1, 8, 0, "a", "d"), (2, 1, 0, "b", "c")), ["k"], ORDER, True), "t")
    assert rows_of(target) == rows_of(at((1, 8, 0, None, "d"), (2, 1, 0, "b", "c")))
    late = keep(I.merge_changes(target, at((1, 6, 0, "late", "u")), ["k"], ORDER, True), "t")
    assert rows_of(I.live(late)) == [(2, 1, 0, "b")]
    assert rows_of(I.apply_changes(late, at((1, 9, 0, "new", "c")), ["k"], ORDER, True)) == [(1, 9, 0, "new"), (2, 1, 0, "b")]
    # From time 8 on the tombstone is still kept; past it, it goes, and what it would have refused is refused by its age.
    assert I.merge_changes(late, at((1, 7, 0, "late", "u")), ["k"], ORDER, True, since="8").count() == 2
    pruned = keep(I.merge_changes(late, at((1, 7, 0, "late", "u"), (3, 9, 0, "c", "c")), ["k"], ORDER, True, since="9"), "t")
    assert rows_of(pruned) == [(2, 1, 0, "b", "c"), (3, 9, 0, "c", "c")]
    assert rows_of(I.too_late(at((1, 7, 0, "late", "u"), (3, None, 0, "c", "c"), (4, 9, 0, "c", "c")), ORDER, "9").select("k")) == [(1,), (3,)]


def test_changes_of_an_empty_log(spark):
    none = spark.createDataFrame([], LOG)
    assert I.merge_changes(I.merge_changes(None, none, ["k"], ORDER, True), none, ["k"], ORDER, True).count() == 0


def sink_of(spark, schema):
    return Z.KeyedSink(spark, new_path(spark, "sink"), ["k"], ORDER, schema)


def test_a_micro_batch_never_reads_the_table(spark):
    """Batches with late rows, a restart, a replay from an empty state; the sink isn't read while they are written."""
    rows = [(k, ts, seq, v) for k, ts, seq, v, _ in random_log(60, 7) if k is not None]
    frame = spark.createDataFrame(rows, "k int, ts int, seq int, v string").withColumn("v", F.concat_ws("-", "ts", "seq"))  # ties are equal
    path, sink, checkpoint, plans = new_path(spark, "in"), sink_of(spark, frame.schema), new_path(spark, "checkpoint"), []

    def seen(write):
        def run(batch, number):
            plans.append(batch._jdf.queryExecution().toString())
            write(batch, number)

        return run

    def run(at):
        return Z.bounded(Z.last_of_key(Z.source(spark, path, frame.schema, 1), sink.key, sink.order), at, seen(sink.writer(at)))

    parts = frame.repartition(3, "v").withColumn("_p", F.spark_partition_id())
    for i in range(3):
        parts.filter(F.col("_p") == i).drop("_p").coalesce(1).write.mode("append").parquet(path)
        run(checkpoint)  # each a restart from the checkpoint
    want = rows_of(I.latest(frame, ["k"], ORDER))
    assert rows_of(sink.read()) == want
    assert Z.rows_written(run(checkpoint)) == 0
    run(new_path(spark, "checkpoint"))
    assert rows_of(sink.read()) == want == rows_of(sink.folded().read())
    assert plans and not any(os.path.basename(sink.path) in p for p in plans)


def test_a_batch_that_comes_again(spark):
    frame = spark.createDataFrame([(1, 1, 1, "a")], "k int, ts int, seq int, v string")
    sink = sink_of(spark, frame.schema)
    for _ in range(2):
        sink.writer("c")(frame, 0)
    assert sink.read().count() == 1 and spark.read.parquet(sink.path).count() == 1


def test_files_are_created_once_and_whole(spark):
    path = f"{new_path(spark, 'once')}/a.json"
    assert create_once(spark, path, "one") and not create_once(spark, path, "two")
    at = path.removeprefix("file:")
    assert open(at).read() == "one" and [f for f in os.listdir(os.path.dirname(at)) if not f.endswith(".crc")] == ["a.json"]


def test_a_dead_writer_blocks_nobody(spark):
    """What a writer leaves that died before its commit is no commit."""
    log = T.ChangeLog.create(spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], "2024-01-01 00:00:00")
    open(f"{log.path.removeprefix('file:')}/commits/_part-dead", "w").write('{"version": 2, "comm')
    assert log.update(F.lit(True), {"v": F.lit("b")}, "2024-01-02 00:00:00") == 2
    assert rows_of(log.read()) == [(1, "b")]


def test_two_runs_take_two_numbers(spark):
    """The second run reads the state before the first one has saved."""
    state = I.State(spark, new_path(spark, "state"))
    state.save("f", [("t", "0", {}, 1)])
    late, rows = I.State(spark, state.path), state.rows()
    known = spark.createDataFrame(rows.collect(), rows.schema)
    late.rows = lambda: known
    assert [state.save("f", [("t", "1", {}, 1)]), late.save("f", [("t", "2", {}, 1)])] == [2, 3]
    assert sorted(r["run"] for r in state.rows().collect()) == [1, 2, 3]


def files_in(path):
    path = path.removeprefix("file:")
    return {os.path.basename(d): sorted(os.path.getsize(f"{d}/{f}") for f in names if f.endswith(".parquet")) for d, _, names in os.walk(path) if any(f.endswith(".parquet") for f in names)}


def test_compaction_keeps_every_partition(spark):
    path, to = new_path(spark, "many"), new_path(spark, "few")
    rows = spark.range(1000).select("id", F.when(F.col("id") < 700, "a b").when(F.col("id") < 900, "c+d").otherwise(None).alias("p"))
    rows.filter("p = 'a b'").repartition(4).write.partitionBy("p").parquet(path)
    rows.filter("p = 'c+d' or p is null").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    done = T.compact(spark, path, to, 1 << 20, partition="p").collect()
    assert [(r["files_before"], r["files_after"]) for r in done] == [(4, 1)]
    assert rows_of(spark.read.parquet(to)) == rows_of(rows)
    assert sorted(len(f) for f in files_in(to).values()) == [1, 1, 1]
    # Nothing more to do; a condition leaves partitions; files over the largest size are cut.
    assert T.compact(spark, to, new_path(spark, "none"), 1 << 20, partition="p").count() == 0
    assert T.compact(spark, path, new_path(spark, "none"), 1 << 20, partition="p", where=F.col("p") == "c+d").count() == 0
    cut = new_path(spark, "cut")
    done = T.compact(spark, to, cut, 1000, min_files=1, partition="p", where=F.col("p") == "a b", least_bytes=1, most_bytes=1500).collect()
    assert len(done) == 1 and rows_of(spark.read.parquet(cut)) == rows_of(rows) and len(files_in(cut)["p=a%20b" if "p=a%20b" in files_in(cut) else "p=a b"]) > 1


def test_compaction_of_one_folder(spark):
    path, to = new_path(spark, "many"), new_path(spark, "few")
    spark.range(1000).repartition(5).write.parquet(path)
    assert T.compact(spark, path, to, 100).count() == 0  # no file is too small
    assert [r["files_after"] for r in T.compact(spark, path, to, 1 << 20).collect()] == [1]
    assert rows_of(spark.read.parquet(to)) == rows_of(spark.range(1000))


def test_a_small_merge_finds_its_rows_where_they_lie(spark):
    """The table's rows meet a broadcast of the changed keys before anything is shuffled."""
    log = T.ChangeLog.create(spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v")), ["k"], "2024-01-01 00:00:00")
    plans, commit = [], log._commit

    def seen(make, *rest):
        plans.append(make(1)[0]._jdf.queryExecution().executedPlan().toString())
        return commit(make, *rest)

    log._commit = seen
    log.merge(spark.createDataFrame([(5, "b"), (2000, "c")], "k long, v string"), "2024-01-02 00:00:00")
    assert "LeftSemi" in plans[0] and "BroadcastHashJoin" in plans[0] and "SortMergeJoin [k" not in plans[0].split("LeftSemi")[1]
    assert log.read().filter("v <> 'a'").count() == 2 and log.read().count() == 1001
    with pytest.raises(ValueError, match="several rows of {'k': 7}"):
        log.merge(spark.createDataFrame([(7, "b"), (7, "c"), (8, "d")], "k long, v string"), "2024-01-03 00:00:00")
