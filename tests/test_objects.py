"""Refusals and properties of the object layer and the metrics."""

import pytest

from lodestrata.operators import metrics as X
from lodestrata.operators import objects as O
from lodestrata.plans import metrics as PM
from lodestrata.plans import model as M
from lodestrata.plans.objects import SORT, with_nulls


def c(field, op, **v):
    return {"field": field, "op": op, **v}


def nested(depth):
    node = {"clause": c("c_nationkey", "eq", value=1)}
    for _ in range(depth - 1):
        node = {"group": "and", "items": [node]}
    return node


@pytest.mark.parametrize(
    "spec",
    [
        c("c_nationkey", "in", values=[]),
        c("c_nationkey", "between", values=[1]),
        c("c_nationkey", "is_null", value=1),
        c("c_nationkey", "like", value=1),
        c("nothing", "eq", value=1),
        c("c_nationkey", "eq", value=1, source="linked"),
    ],
)
def test_refused_clauses(spark, small, spec):
    with pytest.raises(ValueError):
        O.clause(M.customer(spark, small), spec)


def test_tree_limits(spark, small):
    of = M.customer(spark, small)
    O.tree(of, nested(6))
    with pytest.raises(ValueError, match="deep"):
        O.tree(of, nested(7))
    wide = {"group": "or", "items": [{"clause": c("c_nationkey", "eq", value=1)}] * 99}
    O.tree(of, wide)
    with pytest.raises(ValueError, match="nodes"):
        O.tree(of, {"group": "or", "items": [{"clause": c("c_nationkey", "eq", value=1)}] * 100})


def test_capabilities(spark, small):
    of = M.customer(spark, small)
    shown = O.ObjectType("T", of.frame, of.key, {"c_name": O.Property("array_string"), "c_custkey": O.Property("bigint", filterable=False, sortable=False)})
    for call in (lambda: O.clause(shown, c("c_name", "eq", value="x")), lambda: O.clause(shown, c("c_custkey", "eq", value=1)), lambda: O.sort_keys(shown, [{"field": "c_custkey"}]), lambda: O.search(shown, "x"), lambda: O.measure(shown, {"op": "sum", "property": "c_custkey"})):
        with pytest.raises(ValueError):
            call()


def test_guards(spark, small):
    with pytest.raises(ValueError, match="needs a filter"):
        O.select(M.lineitem(spark, small))
    with pytest.raises(ValueError, match="500"):
        O.by_offset(M.orders(spark, small).frame, 0, 501)
    with pytest.raises(ValueError, match="page"):
        O.page_frame(M.orders(spark, small), {"page_size": 201})
    with pytest.raises(ValueError, match="another filter"):
        O.read_cursor({"filters": [c("c_nationkey", "eq", value=1)]}, O.make_cursor({}, [1]))
    with pytest.raises(ValueError):
        O.read_cursor({}, "no cursor")
    with pytest.raises(ValueError, match="broken"):
        O.run_set(M.customer(spark, small), '{"sort": [{"field": "gone"}]}')


def test_walking_pages(spark, small):
    """All pages forward, and back again, are the whole ordered list, with nulls and mixed directions."""
    of = with_nulls(spark, small)
    request = SORT | {"page_size": 190}
    keys = O.sort_keys(of, request["sort"])
    whole = [r["o_orderkey"] for r in O.ordered(O.select(of, request["filters"]), keys).collect()]
    got, page = [], O.page(of, request)
    while True:
        got += [r["o_orderkey"] for r in page.rows]
        if not page.has_next:
            break
        page = O.page(of, request | {"direction": "next", "cursor": page.next})
    assert got == whole
    back, page = [], O.page(of, request | {"direction": "last"})
    assert not page.has_next
    while True:
        back = [r["o_orderkey"] for r in page.rows] + back
        if not page.has_previous:
            break
        page = O.page(of, request | {"direction": "previous", "cursor": page.previous})
    assert back == whole


def test_metric_refusals(spark, small):
    m = PM.registry(spark, small)
    with pytest.raises(ValueError, match="catalog_only"):
        m.column("planned")
    for formula in ("abs(value)", "value.real", "value ** 2", "unknown + 1", "value +", "'a'"):
        with pytest.raises(ValueError):
            X.Metrics(m.of, {**m.specs, "bad": {"kind": "derived", "formula": formula}}).column("bad")
    with pytest.raises(ValueError):
        m.roll_up_allowed("share", over_time=False)
    with pytest.raises(ValueError):
        m.roll_up_allowed("held", over_time=True)
    with pytest.raises(ValueError, match="date"):
        X.as_of_rule(M.balance_frame(spark, small), "snap_date", "selected_date")


def test_additivity(spark, small):
    m = X.Metrics(M.orders(spark, small), {**PM.SPECS, "twice": {"kind": "derived", "formula": "2 * value"}, "mix": {"kind": "derived", "formula": "value - held"}})
    assert [m.additivity(n) for n in ("n", "share", "held", "open_value", "twice", "mix")] == ["additive", "non_additive", "semi_additive", "additive", "non_additive", "semi_additive"]


def test_ratio_is_not_a_sum_of_ratios(spark):
    rows = spark.createDataFrame([("a", 1.0, "F"), ("a", 3.0, "O"), ("b", 0.0, "O")], "k string, v double, s string")
    of = O.ObjectType("T", rows, ("k",), {"k": O.Property("string"), "v": O.Property("decimal(18,2)", aggregatable=True), "s": O.Property("string")})
    m = X.Metrics(of, {"part": {"kind": "simple", "op": "sum", "property": "v", "filters": [c("s", "eq", value="F")]}, "all": {"kind": "simple", "op": "sum", "property": "v"}, "share": {"kind": "ratio", "numerator": "part", "denominator": "all"}})
    assert {r["k"]: r["share"] for r in m.query(["share"], ["k"]).collect()} == {"a": 0.25, "b": None}
