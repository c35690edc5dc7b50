"""Properties of histories: states by day, rows beside a row, and late rows, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import vault as V
from lodestrata.plans import joins, modelling
from lodestrata.shared import keep

ROW = "k string, a string, ts timestamp_ntz, seq int"
BEGIN = dt.datetime(2024, 1, 1)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def random_rows(n, seed, keys="xyz"):
    r = random.Random(seed)
    when = lambda: r.choice([None, BEGIN + dt.timedelta(hours=12 * r.randrange(40)), BEGIN + dt.timedelta(hours=r.randrange(480))])
    return [(r.choice([None, *keys]), r.choice([None, "A", "B"]), when(), r.choice([None, r.randrange(5)])) for _ in range(n)]


def states(rows, days):
    """For each key and day its latest row that isn't after the day's beginning."""
    out = []
    low = lambda v: (v is not None, v if v is not None else 0)
    for k in {r[0] for r in rows}:
        for day in days:
            start = dt.datetime.combine(day, dt.time())
            own = [r for r in rows if r[0] == k and (r[2] is None or r[2] <= start)]
            if own:
                best = max(own, key=lambda r: (r[2] is not None, r[2] or BEGIN, low(r[3]), (r[1] is not None, r[1] or "")))
                out.append((k, day, best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("days", [[0, 1, 2, 3, 4, 5], [-40, 2, 3, 9, 400], [7], []])
def test_states_by_day(spark, days):
    rows, calendar = random_rows(60, len(days)), [(BEGIN + dt.timedelta(days=d)).date() for d in days]
    frame = spark.createDataFrame(rows, ROW)
    got = V.states_by_day({"s": (frame, "ts", ["a"])}, ["k"], spark.createDataFrame([(d,) for d in [*calendar, *calendar, None]], "day date"), "seq")
    assert rows_of(got.select("k", "day", "s.a")) == states(rows, calendar)


def test_states_of_two_satellites(spark):
    rows, calendar = random_rows(80, 5), [(BEGIN + dt.timedelta(days=d)).date() for d in (1, 2, 5, 6, 11)]
    frame = spark.createDataFrame(rows, ROW)
    two = {"p": (frame.filter("a = 'A'"), "ts", ["seq"]), "q": (frame.filter("a = 'B'"), "ts", ["seq"])}
    got = {(r["k"], r["day"]): (r["p"] and r["p"]["seq"], r["q"] and r["q"]["seq"]) for r in V.states_by_day(two, ["k"], spark.createDataFrame([(d,) for d in calendar], "day date"), "seq").collect()}
    swapped = lambda value: {(k, d): v for k, d, v in states([(r[0], r[3], r[2], r[3]) for r in rows if r[1] == value], calendar)}
    p, q = swapped("A"), swapped("B")
    assert got == {at: (p.get(at), q.get(at)) for at in {*p, *q}}


def test_states_of_an_empty_table(spark):
    none = spark.createDataFrame([], ROW)
    assert V.states_by_day({"s": (none, "ts", ["a"])}, ["k"], spark.createDataFrame([(BEGIN.date(),)], "day date")).count() == 0


def test_no_join_of_keys_and_days(spark, small):
    for query in (joins.pit, joins.j_effective_range, modelling.dv_pit):
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_key_with_two_million_rows(spark):
    """At the real limits: states by day, ranges, and a late row in the middle of the key's history."""
    n = 2_000_000
    hot = spark.range(n).select(F.lit("hot").alias("k"), F.expr("cast(id div 5 % 7 as string)").alias("a"), F.expr("timestampadd(second, id, timestamp_ntz'2024-01-01 00:00:00')").alias("ts"), F.col("id").cast("int").alias("seq"))
    hot = keep(hot.union(spark.createDataFrame([("cold", "A", BEGIN, 1)], ROW)), "hot")
    day = lambda i: BEGIN.date() + dt.timedelta(days=i)
    got = V.states_by_day({"s": (hot, "ts", ["seq"])}, ["k"], hot.select(F.to_date("ts").alias("day")), "seq").filter("k = 'hot'").select("day", "s.seq").orderBy("day").collect()
    assert [tuple(r) for r in got] == [(day(i), i * 86400) for i in range(24)]
    assert V.heavy_keys(hot, ["k"])[1] == n
    found = V.scd2(hot, ["k"], ["a"], "ts", "seq")
    assert found.filter("k = 'hot'").agg(F.count("*"), F.count("expiry_date"), F.sum(F.expr("timestampdiff(second, effective_date, expiry_date)"))).first()[:] == (n // 5, n // 5 - 1, n - 5)
    history = keep(V.splice(None, hot, "k", ["a"], "ts", "seq"), "history")
    late = spark.createDataFrame([("hot", "late", BEGIN + dt.timedelta(seconds=1_000_001, milliseconds=500), 0)], ROW)
    got = V.splice(history, late, "k", ["a"], "ts", "seq").select("a", "seq", "changed")
    assert rows_of(got) == rows_of(spark.createDataFrame([("late", 0, True), (str(1_000_002 // 5 % 7), 1_000_002, True)], "a string, seq int, changed boolean"))


@pytest.mark.parametrize("limit", [1_000_000, 6])
def test_any_batches_are_one_load(spark, monkeypatch, limit):
    """Whatever the order and the size of the batches, the history is that of one load; small limits cut heavy keys."""
    monkeypatch.setattr(V, "SORT_ROWS", limit)
    for seed in range(3):
        rows = random_rows(50, seed)
        rows += random.Random(seed).sample(rows, 8)  # rows that come again
        frame = spark.createDataFrame(rows, ROW)
        want = rows_of(V.splice(None, frame, "k", ["a"], "ts", "seq"))
        assert len(want) == len(set(rows))
        random.Random(seed + 9).shuffle(rows)
        cuts = sorted(random.Random(seed).sample(range(1, len(rows)), 3))
        history = None
        for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            changes = keep(V.splice(history, spark.createDataFrame(rows[lo:hi], ROW), "k", ["a"], "ts", "seq"), "changes")
            history = keep(V.spliced(history, changes, "k", "ts", "seq"), "history")
        assert rows_of(history) == want
        assert V.splice(history, frame, "k", ["a"], "ts", "seq").count() == 0  # all of it again
        points = lambda h: h.filter("changed")
        assert rows_of(V.ranges(points(history), ["k"], ["a"], "ts", "seq")) == rows_of(V.ranges(points(spark.createDataFrame(want, history.schema)), ["k"], ["a"], "ts", "seq"))


def test_ranges_of_heavy_keys(spark, monkeypatch):
    rows = [(k, random.Random(i).choice("ABC"), BEGIN + dt.timedelta(minutes=i), i) for i in range(90) for k in (["x", "y"] if i % 3 else ["x"])]
    frame = spark.createDataFrame(rows, ROW)
    want = rows_of(V.scd2(frame, ["k"], ["a"], "ts", "seq"))
    monkeypatch.setattr(V, "SORT_ROWS", 20)
    assert rows_of(V.scd2(frame, ["k"], ["a"], "ts", "seq")) == want
    monkeypatch.setattr(V, "MOST_HEAVY", 1)  # the limit is then all rows of heavy keys: none is over it
    assert V.heavy_keys(frame, ["k"]) is None


def test_a_satellite_takes_late_rows(spark):
    at = lambda *x: spark.createDataFrame([("h", a, BEGIN + dt.timedelta(hours=t), 1) for t, a in x], ROW)
    first = V.satellite(None, at((10, "A")), "k", ["a"], "ts", "seq")
    assert [(r["a"], r["ts"].hour) for r in V.satellite(first, at((5, "B"), (10, "A"), (11, "A")), "k", ["a"], "ts", "seq").collect()] == [("B", 5)]


def test_effectivity_of_a_spliced_history(spark):
    """Ranges from a history that was loaded backwards are those of all rows."""
    rows = [(k, random.Random(i).choice("AB"), BEGIN + dt.timedelta(minutes=i), i) for i in range(40) for k in ("x", None)]
    history = None
    for lo in (60, 40, 20, 0):
        changes = keep(V.splice(history, spark.createDataFrame(rows[lo : lo + 20], ROW), "k", ["a"], "ts", "seq"), "changes")
        history = keep(V.spliced(history, changes, "k", "ts", "seq"), "history")
    got = V.ranges(history.filter("changed"), ["k"], ["a"], "ts", "seq")
    assert rows_of(got) == rows_of(V.effectivity(spark.createDataFrame(rows, ROW), ["k"], ["a"], "ts", "seq")) and got.filter("is_current").count() == 2
