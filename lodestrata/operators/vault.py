"""Warehouse modelling: hash keys, hubs, links, satellites, as-of joins, slowly changing dimensions and stars.

Loads are idempotent: each takes what is stored and what has arrived and returns the rows to add; ``splice`` also returns
stored rows that late ones change.  "Latest" is by source time and then by sequence.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import keep, null_safe

#: Fixed value: what stands for null in a hash, and the delimiter.
NULL_TOKEN, DELIMITER = "^^", "||"
#: A key of more rows is sorted by several tasks.  Over ``MOST_HEAVY`` times as many rows in all, the limit grows with
#: them, so that there are never more heavy keys than that.
SORT_ROWS, MOST_HEAVY = 1_000_000, 400_000


def hash_key(*columns: str | Column) -> Column:
    """SHA-256 of trimmed upper-case key parts; null has a token of its own."""
    parts = [F.coalesce(F.upper(F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))), F.lit(NULL_TOKEN)) for c in columns]
    return F.sha2(F.concat_ws(DELIMITER, *parts), 256)


def hash_diff(*columns: str) -> Column:
    """SHA-256 of attributes in the order of their names; case and blanks count."""
    return F.sha2(F.concat_ws(DELIMITER, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in sorted(columns)]), 256)


def hub(existing: DataFrame | None, rows: DataFrame, key: str, business: list[str], *carried: str) -> DataFrame:
    """New business keys with their hash; of the rows of a key the least carried values are taken."""
    new = rows.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in business])).withColumn(key, hash_key(*business))
    new = new.groupBy(key, *business).agg(F.min(F.struct(*carried)).alias("_c")).select(key, *business, "_c.*") if carried else new.select(key, *business).distinct()
    return new if existing is None else new.join(existing, key, "left_anti")


def link(existing: DataFrame | None, rows: DataFrame, key: str, hubs: dict[str, list[str]]) -> DataFrame:
    """New relations: the hash of the hubs' hashes, and these."""
    new = rows.select(*[hash_key(*business).alias(name) for name, business in hubs.items()]).distinct().withColumn(key, hash_key(*hubs))
    new = new.select(key, *hubs)
    return new if existing is None else new.join(existing, key, "left_anti")


def beside(rows: DataFrame, key: list[str], order: list[str], value: Column, name: str, heavy: tuple[DataFrame, int] | None, ahead: bool = False) -> DataFrame:
    """Adds ``name``: the ``value`` of the row before (or behind) of the same key, null where there is none.

    A window sorts each key's rows in one task.  The keys that ``heavy_keys`` found are instead cut into stretches by
    ranges of key and order; within a stretch the window does it, and a stretch's first row takes the value from the end
    of the key's last stretch before it.  Null keys count as one key.
    """
    sort = [F.desc(c) if ahead else F.asc(c) for c in order]
    marked = rows.withColumn("_value", F.struct(value.alias("value")))
    step = lambda frame, *by: frame.withColumn("_beside", F.lag("_value").over(Window.partitionBy(*by).orderBy(*sort)))
    done = lambda frame: frame.select(*rows.columns, F.col("_beside.value").alias(name))
    if heavy is None:
        return done(step(marked, *key))
    keys, n_rows = heavy
    light = step(null_safe(marked, F.broadcast(keys), key, "left_anti"), *key)
    cut = null_safe(marked, F.broadcast(keys), key, "left_semi").repartitionByRange(-(-n_rows // SORT_ROWS), *key, *sort)
    cut = keep(cut.withColumn("_stretch", F.spark_partition_id()), "stretches")
    end = (F.min_by if ahead else F.max_by)("_value", F.struct(*order))
    ends = cut.groupBy(*key, "_stretch").agg(end.alias("_end"))  # about as many as stretches and heavy keys
    ends = ends.select(*key, "_stretch", F.lag("_end").over(Window.partitionBy(*key).orderBy("_stretch")).alias("_carried"))
    filled = null_safe(step(cut, *key, "_stretch"), ends, [*key, "_stretch"], "inner").withColumn("_beside", F.coalesce("_beside", "_carried"))
    return done(light).unionByName(done(filled))


def heavy_keys(rows: DataFrame, key: list[str]) -> tuple[DataFrame, int] | None:
    """Keys with too many rows for one task, fewer than ``MOST_HEAVY``, and the number of their rows; None if there are none."""
    if rows.count() <= SORT_ROWS:
        return None
    big = keep(rows.groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > SORT_ROWS), "key-counts")
    total = big.agg(F.sum("_n")).first()[0]
    if total is None:
        return None
    heavy = big.filter(F.col("_n") > max(SORT_ROWS, total // MOST_HEAVY))
    n_rows = heavy.agg(F.sum("_n")).first()[0]
    return None if n_rows is None else (heavy.select(*key), n_rows)


def splice(history: DataFrame | None, rows: DataFrame, key: str, attributes: list[str], ts: str, seq: str) -> DataFrame:
    """What a batch does to a history: rows to add, and stored rows that now are, or no longer are, a change.

    A history holds every row that has arrived, each with ``changed``: whether it differs from the row before of its key.
    Rows may come in any order and in any batches.  Of each key only the stored rows between the first and the last arrived
    one, and the one to either side, are derived anew.  A row that is stored already, or that comes twice, counts once.
    Equal times are ordered by ``seq``, then by hash; null keys count as one key.
    """
    return _spliced_rows(history, rows, key, attributes, ts, seq).drop("_stored")


def _spliced_rows(history: DataFrame | None, rows: DataFrame, key: str, attributes: list[str], ts: str, seq: str) -> DataFrame:
    row = [key, "hash_diff", *attributes, ts, seq]
    both = new = rows.withColumn("hash_diff", hash_diff(*attributes)).select(*row, F.lit(None).cast("boolean").alias("_stored"), F.lit(True).alias("_mine"))
    keys = rows.select(key)
    if history is not None:
        at = F.struct(ts, seq, "hash_diff")
        spans = new.groupBy(key).agg(F.min(at).alias("_low"), F.max(at).alias("_high"))
        near = null_safe(history, spans, [key], "inner").withColumn("_at", at)
        before, behind = F.when(F.col("_at") < F.col("_low"), F.col("_at")), F.when(F.col("_at") > F.col("_high"), F.col("_at"))
        stored = F.struct(*row, F.col("changed").alias("_stored"))
        sides = near.filter("_at < _low or _at > _high").groupBy(key).agg(F.max_by(stored, before).alias("_before"), F.min_by(stored, behind).alias("_behind"))
        sides = sides.select(F.posexplode(F.array("_before", "_behind")).alias("_side", "_r")).filter("_r is not null")
        # The row before the first arrived one is there for comparison: its own predecessor isn't.
        both = new.unionByName(near.filter("_at between _low and _high").select(stored.alias("_r"), F.lit(True).alias("_mine")).unionByName(sides.select("_r", (F.col("_side") == 1).alias("_mine"))).select("_r.*", "_mine"))
        keys = keys.union(history.select(key))
    both = both.withColumn("_new", F.col("_stored").isNull())
    marked = beside(both, [key], [ts, seq, "hash_diff", "_new"], F.struct(ts, seq, "hash_diff"), "_before", heavy_keys(keys, [key]))
    again = F.col("_before").eqNullSafe(F.struct(ts, seq, "hash_diff"))
    marked = marked.withColumn("changed", ~F.col("_before.hash_diff").eqNullSafe(F.col("hash_diff")))
    return marked.filter(F.col("_mine") & ((F.col("_new") & ~again) | (F.col("_stored") != F.col("changed")))).select(*row, "changed", "_stored")


def spliced(history: DataFrame | None, changes: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """The history after a ``splice``, whose changes are read twice: keep them before."""
    return changes if history is None else null_safe(history, changes.select(key, ts, seq, "hash_diff"), [key, ts, seq, "hash_diff"], "left_anti").unionByName(changes)


def satellite(existing: DataFrame | None, rows: DataFrame, key: str, attributes: list[str], ts: str, seq: str) -> DataFrame:
    """Rows to add to a satellite: those whose attributes differ from the row before of the same key.

    A late row is placed among the stored ones.  A satellite doesn't hold the rows that changed nothing, so that what lies
    between its rows is taken as unchanged, and a stored row that a late one makes needless stays; where each row must be
    exact, keep a history and ``splice`` it.
    """
    stored = None if existing is None else existing.withColumn("changed", F.lit(True))
    return _spliced_rows(stored, rows, key, attributes, ts, seq).filter("changed and _stored is null").select(key, "hash_diff", *attributes, ts, seq)


def effectivity(rows: DataFrame, driving: list[str], partner: list[str], ts: str, seq: str) -> DataFrame:
    """Open and close times of a link by its driving key: it closes when the partner changes."""
    return scd2(rows, driving, partner, ts, seq)


def scd2(rows: DataFrame, key: list[str], attributes: list[str], ts: str, seq: str) -> DataFrame:
    """Effective ranges of the attributes of each key from its change points; the last range is open and current.

    Rows that tie in time and sequence are ordered by their attributes.
    """
    mark, heavy = F.struct(*attributes), heavy_keys(rows, key)
    points = beside(rows.select(*key, *attributes, ts, seq), key, [ts, seq, *attributes], mark, "_before", heavy)
    return _ranges(points.filter(~F.col("_before").eqNullSafe(mark)), key, attributes, ts, seq, heavy)


def ranges(points: DataFrame, key: list[str], attributes: list[str], ts: str, seq: str) -> DataFrame:
    """Effective ranges from change points, such as the changed rows of a spliced history."""
    return _ranges(points, key, attributes, ts, seq, heavy_keys(points, key))


def _ranges(points: DataFrame, key: list[str], attributes: list[str], ts: str, seq: str, heavy: tuple[DataFrame, int] | None) -> DataFrame:
    ends = beside(points.select(*key, *attributes, ts, seq), key, [ts, seq, *attributes], F.struct(ts), "_end", heavy, ahead=True)
    return ends.select(*key, *attributes, F.col(ts).alias("effective_date"), F.col("_end")[ts].alias("expiry_date"), F.col("_end").isNull().alias("is_current"))


def scd2_apply(stored: DataFrame, delta: DataFrame, key: list[str], attributes: list[str], at: Column) -> DataFrame:
    """Close the open rows that changed at ``at`` and add the new ones; ``delta`` has one row a key."""
    open_, closed = stored.filter("is_current"), stored.filter("not is_current")
    new = delta.select(*[F.col(k) for k in key], *[F.col(a).alias(f"_n_{a}") for a in attributes], F.lit(True).alias("_new"))
    both = open_.join(new, key, "full_outer")
    same = reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(f"_n_{a}")) for a in attributes])
    old = F.col("is_current").isNotNull()
    changes = F.col("_new").isNotNull() & (~old | ~same)
    kept = both.filter(old).select(*key, *attributes, "effective_date", F.when(changes, at).otherwise(F.col("expiry_date")).alias("expiry_date"), (~changes).alias("is_current"))
    added = both.filter(changes).select(*key, *[F.col(f"_n_{a}").alias(a) for a in attributes], at.alias("effective_date"), F.lit(None).cast(stored.schema["expiry_date"].dataType).alias("expiry_date"), F.lit(True).alias("is_current"))
    return closed.select(kept.columns).union(kept).union(added)


def states_by_day(satellites: dict[str, tuple[DataFrame, str, list[str]]], key: list[str], days: DataFrame, seq: str | None = None) -> DataFrame:
    """``key, day`` and for each satellite {name: (rows, time, columns)} a struct ``name``: its row in effect as the day begins.

    Rows are first brought together by key and the day from which they are in effect, the latest of each satellite only,
    before the shuffle.  What is left of a key, at most a row a day, is filled forward, and each row is emitted for the
    days up to the next one: no join of keys and days, and no sort of raw rows.  ``days`` has the column ``day``; its
    distinct dates, under four million (years 1 to 9999), are gathered on the driver.  Days before a key's first row
    aren't emitted.  A null time counts as before all others, and null keys match each other; rows that tie in time and
    ``seq`` are ordered by their values.
    """
    calendar = sorted(days.agg(F.collect_set(F.col("day").cast("date"))).first()[0])
    count, low, high = len(calendar), min(calendar, default=None), max(calendar, default=None)
    dense, names, points = not count or (high - low).days == count - 1, list(satellites), None
    for name, (rows, ts, columns) in satellites.items():
        date, order = F.to_date(ts), F.col(seq) if seq else F.lit(0)
        due = F.when(F.col(ts) > date.cast(rows.schema[ts].dataType), F.date_add(date, 1)).otherwise(date)
        state = F.struct(F.col(ts).alias("ts"), order.alias("seq"), F.struct(*columns).alias("row"))
        part = rows.select(*key, F.greatest(due, F.lit(low).cast("date")).alias("_due"), state.alias(name)).filter(F.col("_due") <= F.lit(high).cast("date"))
        points = part if points is None else points.unionByName(part, allowMissingColumns=True)
    if dense:
        points = points.withColumn("_i", F.datediff("_due", F.lit(low).cast("date")))
    else:  # the number of the first day of the calendar that isn't before the date
        froms = [low, *[day + timedelta(1) for day in calendar[:-1]]]
        numbered = days.sparkSession.createDataFrame(list(zip(range(count), froms, calendar, strict=True)), "_i int, _from date, day date")
        dates = numbered.select(F.explode(F.sequence("_from", "day")).alias("_due"), "_i")
        points = points.join(F.broadcast(dates), "_due")
    of_day = points.groupBy(*key, "_i").agg(*[F.max(n).alias(n) for n in names])
    by = Window.partitionBy(*key).orderBy("_i")
    filled = [(F.last(n, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)) if len(names) > 1 else F.col(n)).alias(n) for n in names]
    spans = of_day.select(*key, "_i", F.lead("_i", 1, count).over(by).alias("_next"), *filled)
    each = spans.select(*key, F.explode(F.sequence(F.col("_i"), F.col("_next") - 1)).alias("_i"), *[F.col(n)["row"].alias(n) for n in names])
    if dense:
        each = each.withColumn("day", F.date_add(F.lit(low).cast("date"), F.col("_i")))
    else:
        each = each.join(F.broadcast(numbered.select("_i", "day")), "_i")
    return each.select(*key, "day", *names)


def bridge(frames: list[DataFrame], on: list[list[str]]) -> DataFrame:
    """A path over hubs and links, joined once."""
    out = frames[0]
    for frame, keys in zip(frames[1:], on, strict=True):
        out = out.join(frame, keys)
    return out


def current(rows: DataFrame, key: list[str], ts: str, seq: str) -> DataFrame:
    """The latest row of each key, with map-side combination and no sort of whole groups."""
    others = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(ts, seq)).alias("_r")).select(*key, "_r.*").select(rows.columns)


def audited(rows: DataFrame, source: str, ts: str, loaded: Column, operation: Column) -> DataFrame:
    """Adds the audit columns: load time, source time, record source, operation and the day loaded."""
    return rows.withColumns({"dv_ldt": loaded, "dv_src_ldt": F.col(ts), "dv_src_rec": F.lit(source), "dv_cdc_ops": operation, "dv_ccd": F.to_date(loaded)})


def dimension(rows: DataFrame, key: str, business: list[str], attributes: list[str]) -> DataFrame:
    """A surrogate key by hash, stable over reloads, with business key and attributes and an unknown member.

    Of several rows of a key the one with the greatest attributes, in their order, is taken.
    """
    one = rows.select(hash_key(*business).alias(key), F.struct(*business, *attributes).alias("_r"))
    dim = one.groupBy(key).agg(F.max_by("_r", F.struct(*[F.col(f"_r.{c}") for c in [*attributes, *business]])).alias("_r")).select(key, "_r.*")
    unknown = rows.sparkSession.range(1).select(F.lit("0" * 64).alias(key), *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in [*business, *attributes]])
    return dim.union(unknown)


def fact(rows: DataFrame, dims: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """Adds a key for each dimension {key: (frame, its business columns, the fact's columns)}; orphans get the unknown member."""
    out = rows
    for key, (dim, business, own) in dims.items():
        right = dim.filter(F.col(key) != "0" * 64).select(key, *[F.col(b).alias(f"_b{i}") for i, b in enumerate(business)])
        out = out.join(right, reduce(Column.__and__, [F.col(o) == F.col(f"_b{i}") for i, o in enumerate(own)]), "left").drop(*[f"_b{i}" for i in range(len(business))])
        out = out.withColumn(key, F.coalesce(key, F.lit("0" * 64)))
    return out
