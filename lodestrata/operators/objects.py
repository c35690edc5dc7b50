"""A semantic layer over DataFrames: object types, filters, pages, links, interfaces and aggregates as small requests.

Requests are plain dicts and lists, as a client would send them in JSON.  All checks are made before a job starts.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DEPTH, MAX_NODES, MAX_PAGE, PAGE, MAX_ROWS, BUCKETS = 6, 100, 200, 20, 500, 100
UNITS = {"by_day": "day", "by_week": "week", "by_month": "month", "by_quarter": "quarter", "by_year": "year"}


@dataclass(frozen=True)
class Property:
    """``type`` is a Spark type name, or array_string, which can only be shown."""

    type: str
    filterable: bool = True
    sortable: bool = True
    searchable: bool = False
    aggregatable: bool = False
    hidden: bool = False
    role: str = "none"

    def can(self, what: str) -> bool:
        return self.type != "array_string" and getattr(self, what)


@dataclass(frozen=True)
class DatePolicy:
    """none, snapshot (one column) or effective_range (two columns, the end open and exclusive)."""

    kind: str = "none"
    start: str | None = None
    end: str | None = None


@dataclass(frozen=True)
class ObjectType:
    name: str
    frame: DataFrame
    key: tuple[str, ...]
    properties: dict[str, Property]
    date: DatePolicy = DatePolicy()
    require_filter: bool = False

    def prop(self, name: str, what: str | None = None) -> Property:
        if name not in self.properties:
            raise ValueError(f"{self.name} has no property {name}")
        if what and not self.properties[name].can(what):
            raise ValueError(f"{self.name}.{name} is not {what}")
        return self.properties[name]

    def shown(self) -> list[str]:
        return [n for n, p in self.properties.items() if not p.hidden]

    def on(self, frame: DataFrame) -> ObjectType:
        return ObjectType(self.name, frame, self.key, self.properties, self.date, self.require_filter)


@dataclass(frozen=True)
class LinkType:
    """Column pairs (source, target); ``cardinality`` is one_to_one, one_to_many, many_to_one or many_to_many."""

    name: str
    source: ObjectType
    target: ObjectType
    on: tuple[tuple[str, str], ...]
    cardinality: str = "one_to_many"

    def reverse(self) -> LinkType:
        turned = {"one_to_many": "many_to_one", "many_to_one": "one_to_many"}
        return LinkType(self.name, self.target, self.source, tuple((t, s) for s, t in self.on), turned.get(self.cardinality, self.cardinality))


# Filters

OPERATORS: dict[str, Callable[[Column, Column], Column]] = {
    "eq": lambda c, v: c == v,
    "neq": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
}


def clause(of: ObjectType, spec: dict, linked: ObjectType | None = None) -> Column:
    """One condition.  Null values follow SQL's three-valued logic."""
    side = spec.get("source", "base")
    if side == "linked" and linked is None:
        raise ValueError("source 'linked' needs a join")
    owner = linked if side == "linked" else of
    kind = owner.prop(spec["field"], "filterable").type
    column = F.col(f"linked_{spec['field']}" if side == "linked" else spec["field"])
    operator, has_value = spec["op"], "value" in spec or "values" in spec
    value = lambda v: F.lit(v).cast(kind)
    if operator in ("is_null", "not_null"):
        if has_value:
            raise ValueError(f"{operator} takes no value")
        return column.isNull() if operator == "is_null" else column.isNotNull()
    if operator == "in":
        if not spec.get("values"):
            raise ValueError("'in' needs values")
        return column.isin([value(v) for v in spec["values"]])
    if operator == "between":
        if len(spec.get("values", ())) != 2:
            raise ValueError("'between' needs two values")
        return column.between(*[value(v) for v in spec["values"]])
    if operator == "contains":
        words = str(spec["value"]).split()
        return reduce(Column.__and__, [F.contains(F.lower(column.cast("string")), F.lit(w.lower())) for w in words], F.lit(True))
    if operator not in OPERATORS:
        raise ValueError(f"unknown operator {operator}")
    return OPERATORS[operator](column, value(spec["value"]))


def all_of(of: ObjectType, filters: list[dict], linked: ObjectType | None = None) -> Column:
    return reduce(Column.__and__, [clause(of, f, linked) for f in filters], F.lit(True))


def tree(of: ObjectType, node: dict, linked: ObjectType | None = None) -> Column:
    """A nested group of clauses: {"group": "and" | "or", "items": [...], "negated": bool} or {"clause": {...}}."""
    seen = 0

    def fold(n: dict, depth: int) -> Column:
        nonlocal seen
        seen += 1
        if depth > MAX_DEPTH:
            raise ValueError(f"a condition tree may be {MAX_DEPTH} deep")
        if seen > MAX_NODES:
            raise ValueError(f"a condition tree may have {MAX_NODES} nodes")
        if "clause" in n:
            out = clause(of, n["clause"], linked)
        else:
            parts = [fold(x, depth + 1) for x in n["items"]]
            if not parts:
                raise ValueError("an empty group")
            out = reduce(Column.__and__ if n["group"] == "and" else Column.__or__, parts)
        return ~out if n.get("negated") else out

    return fold(node, 1)


def search(of: ObjectType, text: str) -> DataFrame:
    """Rows with a searchable property that begins with ``text``, in any case."""
    names = [n for n, p in of.properties.items() if p.can("searchable")]
    if not names:
        raise ValueError(f"{of.name} has no searchable property")
    return of.frame.filter(reduce(Column.__or__, [F.startswith(F.lower(F.col(n).cast("string")), F.lit(text.lower())) for n in names]))


def select(of: ObjectType, filters: list[dict] | None = None, where: dict | None = None, date=None, linked: ObjectType | None = None) -> DataFrame:
    """The rows of a type under its date policy, a flat filter list and a condition tree."""
    if of.require_filter and not filters and not where:
        raise ValueError(f"{of.name} needs a filter")
    rows = at_date(of, date)
    if filters:
        rows = rows.filter(all_of(of, filters, linked))
    return rows.filter(tree(of, where, linked)) if where else rows


# Dates


def at_date(of: ObjectType, date=None) -> DataFrame:
    """snapshot: the given date, or else the latest; effective_range: rows whose range holds the date, or else now's."""
    policy = of.date
    if policy.kind == "none":
        return of.frame
    if policy.kind == "snapshot":
        if date is not None:
            return of.frame.filter(F.col(policy.start) == F.lit(date).cast(of.frame.schema[policy.start].dataType))
        latest = of.frame.agg(F.max(policy.start).alias("_latest"))
        return of.frame.join(F.broadcast(latest), F.col(policy.start) == F.col("_latest")).drop("_latest")  # one row
    kind = of.frame.schema[policy.start].dataType
    when = F.lit(date).cast(kind) if date is not None else F.current_timestamp().cast(kind)
    return of.frame.filter((F.col(policy.start) <= when) & (F.col(policy.end).isNull() | (when < F.col(policy.end))))


def latest_dates(of: ObjectType) -> DataFrame:
    return of.frame.groupBy(*of.key).agg(F.max(of.date.start).alias("latest_date"))


# Sort and pages


def sort_keys(of: ObjectType, sort: list[dict], linked: ObjectType | None = None) -> list[tuple[str, bool]]:
    """(column, ascending), with the primary key added so that the order is total."""
    out = []
    for s in sort:
        far = s.get("source") == "linked"
        if far and linked is None:
            raise ValueError("source 'linked' needs a join")
        (linked if far else of).prop(s["field"], "sortable")
        out.append((f"linked_{s['field']}" if far else s["field"], s.get("order", "asc") == "asc"))
    return out + [(k, True) for k in of.key if k not in {n for n, _ in out}]


def ordered(rows: DataFrame, keys: list[tuple[str, bool]], backward: bool = False) -> DataFrame:
    """Nulls are least: first when ascending, last when descending."""
    return rows.orderBy(*[F.col(n).asc_nulls_first() if up != backward else F.col(n).desc_nulls_last() for n, up in keys])


def beyond(keys: list[tuple[str, bool]], values: list, kinds: dict, backward: bool = False) -> Column:
    """Rows after the given key values in the order, or before them."""
    out, equal = F.lit(False), F.lit(True)
    for (name, up), value in zip(keys, values, strict=True):
        column, at = F.col(name), F.lit(value).cast(kinds[name])
        if up != backward:
            further = column.isNotNull() if value is None else column > at
        else:
            further = F.lit(False) if value is None else column.isNull() | (column < at)
        out = out | (equal & further)
        equal = equal & column.eqNullSafe(at)
    return out


def fingerprint(request: dict) -> str:
    return hashlib.sha256(json.dumps({k: request.get(k) for k in ("filters", "where", "sort", "date", "q")}, sort_keys=True, default=str).encode()).hexdigest()[:16]


def make_cursor(request: dict, values: list) -> str:
    return base64.urlsafe_b64encode(json.dumps({"f": fingerprint(request), "v": values}, default=str).encode()).decode()


def read_cursor(request: dict, cursor: str) -> list:
    try:
        held = json.loads(base64.urlsafe_b64decode(cursor))
    except ValueError as e:
        raise ValueError("not a cursor") from e
    if held["f"] != fingerprint(request):
        raise ValueError("the cursor belongs to another filter or sort")
    return held["v"]


def page_frame(of: ObjectType, request: dict, extra: int = 0) -> DataFrame:
    """The rows of a keyset page in order: direction first, next, previous or last."""
    size = request.get("page_size", PAGE)
    if not 1 <= size <= MAX_PAGE:
        raise ValueError(f"a page has 1 to {MAX_PAGE} rows")
    rows = search(of, request["q"]) if request.get("q") else select(of, request.get("filters"), request.get("where"), request.get("date"))
    keys, way = sort_keys(of, request.get("sort", [])), request.get("direction", "first")
    kinds = {n: rows.schema[n].dataType for n, _ in keys}
    backward = way in ("previous", "last")
    if way in ("next", "previous"):
        rows = rows.filter(beyond(keys, read_cursor(request, request["cursor"]), kinds, backward))
    rows = ordered(rows, keys, backward).limit(size + extra)
    return ordered(rows, keys) if backward and not extra else rows


@dataclass(frozen=True)
class Page:
    rows: list
    has_next: bool
    has_previous: bool
    next: str | None
    previous: str | None


def page(of: ObjectType, request: dict) -> Page:
    """A page with its cursors.  One row more than the page is fetched to know whether there is another."""
    size, way = request.get("page_size", PAGE), request.get("direction", "first")
    keys = [n for n, _ in sort_keys(of, request.get("sort", []))]
    rows = page_frame(of, request, extra=1).collect()
    more, rows = len(rows) > size, rows[:size]
    if way in ("previous", "last"):
        rows = rows[::-1]
        after, before = way == "previous", more
    else:
        after, before = more, way == "next"
    cursor = lambda r: make_cursor(request, [r[k] for k in keys])
    return Page(rows, after, before, cursor(rows[-1]) if rows and after else None, cursor(rows[0]) if rows and before else None)


def by_offset(rows: DataFrame, offset: int, limit: int) -> DataFrame:
    if limit > MAX_ROWS:
        raise ValueError(f"at most {MAX_ROWS} rows a call")
    return rows.offset(offset).limit(limit)


def encode_key(values: list) -> str:
    return base64.urlsafe_b64encode(json.dumps(values).encode()).decode()


def get(of: ObjectType, encoded: str) -> DataFrame:
    """One record by its encoded key."""
    values = json.loads(base64.urlsafe_b64decode(encoded))
    if len(values) != len(of.key):
        raise ValueError("a key with another number of parts")
    return of.frame.filter(reduce(Column.__and__, [F.col(k) == F.lit(v).cast(of.frame.schema[k].dataType) for k, v in zip(of.key, values, strict=True)]))


# Links


def follow(link: LinkType, base: DataFrame) -> DataFrame:
    """The distinct target records of the base rows."""
    keys = base.select(*[F.col(s).alias(f"_{i}") for i, (s, _) in enumerate(link.on)]).distinct()
    on = reduce(Column.__and__, [F.col(f"_{i}") == link.target.frame[t] for i, (_, t) in enumerate(link.on)])
    return link.target.frame.join(keys, on, "left_semi")


def two_hops(first: LinkType, second: LinkType, base: DataFrame, mid_filters: list[dict] | None = None) -> DataFrame:
    """The target records two links away; the records between may be filtered."""
    middle = follow(first, base)
    if mid_filters:
        middle = middle.filter(all_of(first.target, mid_filters))
    return follow(second, middle)


def with_linked(link: LinkType, base: DataFrame | None = None) -> DataFrame:
    """Base rows with the linked record's columns as linked_*; rows without a linked record stay."""
    left = link.source.frame if base is None else base
    right = link.target.frame.select(*[F.col(c).alias(f"linked_{c}") for c in link.target.properties])
    return left.join(right, reduce(Column.__and__, [left[s] == right[f"linked_{t}"] for s, t in link.on]), "left")


def check_link(link: LinkType) -> DataFrame:
    """One row: how many targets a link key has at most, orphans on each side, fan-out, and whether that fits the declaration."""
    left = link.source.frame.groupBy(*[F.col(s).alias(f"k{i}") for i, (s, _) in enumerate(link.on)]).agg(F.count("*").alias("n_source"))
    right = link.target.frame.groupBy(*[F.col(t).alias(f"k{i}") for i, (_, t) in enumerate(link.on)]).agg(F.count("*").alias("n_target"))
    both = left.join(right, [f"k{i}" for i in range(len(link.on))], "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = both.agg(
        total("n_source").alias("source_rows"),
        total(F.col("n_source") * F.col("n_target")).alias("joined_rows"),
        total(F.when(F.col("n_target").isNull(), F.col("n_source"))).alias("source_orphans"),
        total(F.when(F.col("n_source").isNull(), F.col("n_target"))).alias("target_orphans"),
        F.coalesce(F.max(F.when(F.col("n_target").isNotNull(), F.col("n_source"))), F.lit(0)).cast("long").alias("max_source_per_key"),
        F.coalesce(F.max("n_target"), F.lit(0)).cast("long").alias("max_target_per_key"),
    )
    one_source, one_target = {"one_to_one": (True, True), "one_to_many": (True, False), "many_to_one": (False, True)}.get(link.cardinality, (False, False))
    fits = (F.lit(not one_source) | (F.col("max_source_per_key") <= 1)) & (F.lit(not one_target) | (F.col("max_target_per_key") <= 1))
    return out.withColumn("fits", fits)


# Interfaces and saved sets


def interface(types: list[ObjectType], shared: dict[str, tuple[str, dict[str, str]]], filters: list[dict] | None = None, limit: int | None = None) -> DataFrame:
    """The union of types by shared properties {name: (type, {object type: its property})}, with ``__type``.

    Records are not merged.  A page is bounded and has no cursor.
    """
    parts = [t.frame.select(F.lit(t.name).alias("__type"), *[F.col(local[t.name]).cast(kind).alias(name) for name, (kind, local) in shared.items()]) for t in types]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    if filters:
        rows = rows.filter(all_of(ObjectType("interface", rows, (), {n: Property(k) for n, (k, _) in shared.items()}), filters))
    return rows.limit(limit) if limit else rows


def run_set(of: ObjectType, saved: str) -> DataFrame:
    """A saved object set run again from its first page; one whose properties are gone is broken."""
    spec = json.loads(saved)
    used = [c["field"] for c in spec.get("filters", [])] + [s["field"] for s in spec.get("sort", [])]
    if gone := [f for f in used if f not in of.properties]:
        raise ValueError(f"broken: {of.name} has no {', '.join(gone)}")
    return page_frame(of, spec | {"direction": "first"})


# Aggregates


def bucket(of: ObjectType, spec: dict) -> Column:
    """A group key: exact, by_day ... by_year (weeks begin on Monday), or by_ranges with bounds [low, high)."""
    of.prop(spec["property"], "filterable")
    column, kind = F.col(spec["property"]), spec.get("bucket", "exact")
    name = spec.get("as", spec["property"])
    if kind == "exact":
        return column.alias(name)
    if kind in UNITS:
        return F.date_trunc(UNITS[kind], column).cast("date").alias(name)
    if kind != "by_ranges":
        raise ValueError(f"unknown bucket {kind}")
    out = F.lit(None).cast("string")
    for low, high in reversed(spec["ranges"]):
        inside = (F.lit(True) if low is None else column >= low) & (F.lit(True) if high is None else column < high)
        out = F.when(inside, F.lit(f"{'' if low is None else low}..{'' if high is None else high}")).otherwise(out)
    return out.alias(name)


def measure(of: ObjectType, spec: dict) -> Column:
    """count, sum, avg, min, max or cardinality (distinct count); money columns are summed exactly."""
    op = spec["op"]
    if op == "count":
        return F.count("*").alias(spec.get("as", "count"))
    kind = of.prop(spec["property"], "aggregatable").type
    column = F.col(spec["property"]).cast(kind)
    name = spec.get("as", f"{op}_{spec['property']}")
    if op == "cardinality":
        return F.count_distinct(column).alias(name)
    if op == "avg":
        return (F.sum(column).cast("double") / F.count(column)).alias(name)
    if op not in ("sum", "min", "max"):
        raise ValueError(f"unknown measure {op}")
    return {"sum": F.sum, "min": F.min, "max": F.max}[op](column).alias(name)


def aggregate(of: ObjectType, rows: DataFrame, groups: list[dict], measures: list[dict], max_buckets: int | None = BUCKETS) -> DataFrame:
    """Grouped measures; with ``max_buckets`` the largest groups by count, then by key."""
    keys = [bucket(of, g) for g in groups]
    names = [g.get("as", g["property"]) for g in groups]
    out = [measure(of, m) for m in measures]
    if not groups or max_buckets is None:
        return rows.groupBy(*keys).agg(*out)
    counted = rows.groupBy(*keys).agg(*out, F.count("*").alias("_n"))
    return counted.orderBy(F.desc("_n"), *[F.col(n).asc_nulls_first() for n in names]).limit(max_buckets).drop("_n")


def top_values(of: ObjectType, rows: DataFrame, name: str, top_k: int) -> DataFrame:
    of.prop(name, "filterable")
    return rows.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), F.col("value").asc_nulls_first()).limit(top_k)


def facets(of: ObjectType, rows: DataFrame) -> DataFrame:
    """Value counts of every dimension property in one pass: ``property, value, cnt``."""
    names = [n for n, p in of.properties.items() if p.role == "dimension"]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("property"), F.col(n).cast("string").alias("value")) for n in names]))
    return rows.select(pairs.alias("p")).groupBy("p.property", "p.value").agg(F.count("*").alias("cnt"))


def expand(start: DataFrame, edges: DataFrame, steps: int, keep, most: int = 8) -> DataFrame:
    """Nodes reached from ``start`` (node) over ``edges`` (src, dst) with the step of their first visit.

    Each node gives at most ``most`` neighbours, the least ones, in one expansion, and none is visited twice.  ``keep``
    writes a frame to shared storage and reads it back after each step.
    """
    from pyspark.sql import Window

    rounds = [keep(start.select("node", F.lit(0).alias("step")).distinct())]
    # The neighbours an expansion may show don't depend on the step, so they are ranked once.
    ranked = edges.select("src", "dst").distinct().withColumn("_r", F.row_number().over(Window.partitionBy("src").orderBy("dst"))).filter(F.col("_r") <= most)
    near = keep(ranked.select("src", "dst"))
    for step in range(1, steps + 1):
        reached = near.join(rounds[-1].select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        rounds.append(keep(reached.join(reduce(DataFrame.union, rounds), "node", "left_anti").withColumn("step", F.lit(step))))
    return reduce(DataFrame.union, rounds)
