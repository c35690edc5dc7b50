"""Named metrics: simple, ratio and derived, with additivity, time rules and growth.

A metric is a small dict.  It becomes aggregate columns, so that several metrics of one scope share one aggregation.
"""

from __future__ import annotations

import ast
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .objects import ObjectType, all_of, measure

TO_DATE = {"wtd": "week", "mtd": "month", "qtd": "quarter", "ytd": "year", "itd": None}
ADDITIVE = ("sum", "count")


class Metrics:
    """A registry of metrics over one object type.

    {"kind": "simple", "op", "property", "filters"?}, {"kind": "ratio", "numerator", "denominator"} and
    {"kind": "derived", "formula"}; all may have "status": "executable" (default) or "catalog_only", "fields": the context
    filters that they take, "time": a semi-additive rule, and a name of their own.
    """

    def __init__(self, of: ObjectType, specs: dict[str, dict]):
        self.of, self.specs = of, specs

    def spec(self, name: str) -> dict:
        if name not in self.specs:
            raise ValueError(f"no metric {name}")
        spec = self.specs[name]
        if spec.get("status", "executable") != "executable":
            raise ValueError(f"{name} is {spec['status']}")
        return spec

    def column(self, name: str) -> Column:
        """The metric as an aggregate column.  Ratios divide sums, never sum ratios; a zero denominator gives null."""
        spec = self.spec(name)
        if spec["kind"] == "simple":
            return simple(self.of, spec)
        if spec["kind"] == "ratio":
            return F.try_divide(self.column(spec["numerator"]).cast("double"), self.column(spec["denominator"]).cast("double"))
        return self._derived(spec["formula"])

    def _derived(self, formula: str) -> Column:
        def fold(node: ast.AST) -> Column:
            if isinstance(node, ast.Expression):
                return fold(node.body)
            if isinstance(node, ast.Constant) and type(node.value) in (int, float):
                return F.lit(node.value)
            if isinstance(node, ast.Name) and node.id in self.specs:
                return self.column(node.id).cast("double")
            if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub | ast.UAdd):
                return -fold(node.operand) if isinstance(node.op, ast.USub) else fold(node.operand)
            if isinstance(node, ast.BinOp):
                left, right = fold(node.left), fold(node.right)
                for kind, work in ((ast.Add, Column.__add__), (ast.Sub, Column.__sub__), (ast.Mult, Column.__mul__), (ast.Div, F.try_divide)):
                    if isinstance(node.op, kind):
                        return work(left, right)
            raise ValueError(f"a formula may have numbers, metrics, + - * / and signs: {ast.unparse(node)}")

        try:
            return fold(ast.parse(formula, mode="eval"))
        except SyntaxError as e:
            raise ValueError("not a formula") from e

    def additivity(self, name: str) -> str:
        """additive, semi_additive (over all but time) or non_additive."""
        spec = self.specs[name]
        if spec["kind"] == "ratio":
            return "non_additive"
        if spec["kind"] == "derived":
            tree = ast.parse(spec["formula"], mode="eval")
            kinds = {self.additivity(n.id) for n in ast.walk(tree) if isinstance(n, ast.Name)}
            linear = not any(isinstance(n, ast.Div | ast.Mult) for n in ast.walk(tree)) and not any(isinstance(n, ast.Constant) for n in ast.walk(tree))
            if not linear or "non_additive" in kinds:
                return "non_additive"
            return "semi_additive" if "semi_additive" in kinds else "additive"
        if spec["op"] not in ADDITIVE:
            return "non_additive"
        return "semi_additive" if spec.get("time") else "additive"

    def roll_up_allowed(self, name: str, over_time: bool) -> None:
        kind = self.additivity(name)
        if kind == "non_additive" or (kind == "semi_additive" and over_time):
            raise ValueError(f"{name} is {kind} and can't be summed{' over time' if over_time else ''}")

    def query(self, names: list[str], groups: list[str], filters: list[dict] | None = None, rows: DataFrame | None = None) -> DataFrame:
        """The metrics by the groups.  A metric takes only the context filters whose fields it declares."""
        rows = self.of.frame if rows is None else rows
        out = []
        for name in names:
            declared = self.spec(name).get("fields")
            own = [f for f in filters or [] if declared is None or f["field"] in declared]
            out.append((own, name))
        if all(own == out[0][0] for own, _ in out):
            scope = rows.filter(all_of(self.of, out[0][0])) if out[0][0] else rows
            return scope.groupBy(*groups).agg(*[self.column(n).alias(n) for _, n in out])
        frames = [(rows.filter(all_of(self.of, own)) if own else rows).groupBy(*groups).agg(self.column(n).alias(n)) for own, n in out]
        if not groups:
            return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), frames)  # one row each
        return reduce(lambda a, b: a.join(b, groups, "full_outer"), frames)


def simple(of: ObjectType, spec: dict) -> Column:
    """One aggregate, over the rows that meet its own condition."""
    if not spec.get("filters"):
        return measure(of, spec)
    test = all_of(of, spec["filters"])
    if spec["op"] == "count":
        return F.count_if(test)
    kind = of.prop(spec["property"], "aggregatable").type
    value = F.when(test, F.col(spec["property"]).cast(kind))
    if spec["op"] == "avg":
        return F.sum(value).cast("double") / F.count(value)
    return {"sum": F.sum, "min": F.min, "max": F.max, "cardinality": F.count_distinct}[spec["op"]](value)


def semi_additive(rows: DataFrame, entity: list[str], date: str, value: str, period: str, rule: str = "end", groups: list[str] = ()) -> DataFrame:
    """Roll-up over time: first each entity's end, start or average of the period, then the sum over entities."""
    pick = {"end": F.max_by(value, date), "start": F.min_by(value, date), "average": F.sum(value).cast("double") / F.count(value)}[rule]
    each = rows.groupBy(*entity, *groups, F.date_trunc(period, date).cast("date").alias("period")).agg(pick.alias("_v"))
    return each.groupBy("period", *groups).agg(F.sum("_v").alias(value))


def as_of_rule(rows: DataFrame, date: str, rule: str, at=None) -> DataFrame:
    """Rows of the snapshot by a rule: latest, selected_date (needs a date) or period_end (the last not after the date)."""
    kind = rows.schema[date].dataType
    if rule == "selected_date":
        if at is None:
            raise ValueError("selected_date needs a date")
        return rows.filter(F.col(date) == F.lit(at).cast(kind))
    if rule not in ("latest", "period_end"):
        raise ValueError(f"unknown rule {rule}")
    seen = rows if rule == "latest" or at is None else rows.filter(F.col(date) <= F.lit(at).cast(kind))
    return rows.join(F.broadcast(seen.agg(F.max(date).alias("_at"))), F.col(date) == F.col("_at")).drop("_at")  # one row


def to_date(rows: DataFrame, date: str, rule: str, at=None) -> DataFrame:
    """wtd, mtd, qtd, ytd or itd up to the date; without a date all rows."""
    if rule not in TO_DATE:
        raise ValueError(f"unknown rule {rule}")
    if at is None:
        return rows
    day, end = F.col(date).cast("date"), F.lit(at).cast("date")
    low = F.lit(True) if TO_DATE[rule] is None else day >= F.date_trunc(TO_DATE[rule], end).cast("date")
    return rows.filter(low & (day <= end))


def to_dates(rows: DataFrame, date: str, at: str, values: dict[str, Column]) -> DataFrame:
    """``rule`` and the sum of each value up to the date under every rule, from one pass over the rows."""
    day, end = F.col(date).cast("date"), F.lit(at).cast("date")
    since = lambda rule: F.lit(True) if TO_DATE[rule] is None else day >= F.date_trunc(TO_DATE[rule], end).cast("date")
    sums = [F.struct(F.lit(rule).alias("rule"), *[F.sum(F.when(since(rule), v)).alias(n) for n, v in values.items()]) for rule in TO_DATE]
    return rows.filter(day <= end).agg(F.array(*sums).alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*")


def growth(rows: DataFrame, date: str, value: str, partition_by: list[str]) -> DataFrame:
    """Growth against the previous snapshot of the same partition; null without one or if it is zero."""
    before = F.lag(value).over(Window.partitionBy(*partition_by).orderBy(date))
    return rows.withColumn("previous", before).withColumn("growth_rate", F.try_divide(F.col(value).cast("double") - F.col("previous").cast("double"), F.col("previous").cast("double")))


def aggregate_then_join(sides: list[tuple[DataFrame, list[str], list[Column]]], names: list[str], how: str = "left") -> DataFrame:
    """Aggregate each side to its key, then join: no row is counted twice.  Keys get the common ``names``."""
    frames = [rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(*aggs) for rows, keys, aggs in sides]
    return reduce(lambda a, b: a.join(b, names, how), frames)


def stale(rows: DataFrame, date: str, at) -> DataFrame:
    """Adds the snapshot's date and whether it is older than the requested one."""
    return rows.withColumn("snapshot_date", F.col(date)).withColumn("is_stale", F.col(date) < F.lit(at).cast(rows.schema[date].dataType))
