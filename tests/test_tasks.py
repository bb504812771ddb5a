"""Tasks are bounded by rows, and rows are exchanged before much is made of them."""

import re
import threading

import pyarrow as pa
import pytest

from labelmill.operators import compose
from labelmill.operators.families import registry as family_registry
from labelmill.plans import bindings, registry


def _exchanges(df) -> list[str]:
    return re.findall(r"Exchange (?:hashpartitioning\([^)]*\)).*", df._jdf.queryExecution().executedPlan().toString())


def test_outputs_are_compared_where_their_lines_are(spark, sf, monkeypatch):
    """One exchange of the order lines; the nine values of each are neither shuffled nor sorted by the hundred million a task."""
    monkeypatch.setattr(bindings, "ROWS_A_TASK", 10)
    lines = bindings.table(spark, sf, "lineitem").count()
    exchanges = _exchanges(registry.QUERIES["trace_diff"](spark, sf))
    assert len(exchanges) == 1 and f", {-(-lines // 10)})" in exchanges[0]


def test_reference_meets_outputs_where_they_are(spark, sf, monkeypatch):
    monkeypatch.setattr(bindings, "ROWS_A_TASK", 10)
    lines = bindings.table(spark, sf, "lineitem").count()
    exchanges = _exchanges(registry.QUERIES["reference_matches"](spark, sf))
    assert sum(f", {-(-lines // 10)})" in e for e in exchanges) == 2 and len(exchanges) == 3


@pytest.mark.parametrize("name", ["api_readback", "config_readback"])
def test_readbacks_have_bounded_tasks(spark, sf, monkeypatch, name):
    monkeypatch.setattr(bindings, "ROWS_A_TASK", 4)
    orders = bindings.table(spark, sf, "orders").count()
    exchanges = _exchanges(registry.QUERIES[name](spark, sf))
    assert exchanges and all(f", {-(-orders // 4)})" in e for e in exchanges)


def test_families_are_made_side_by_side():
    """Work of several names overlaps; results keep the order of the names, and a failure is raised when all have ended."""
    both, done = threading.Barrier(2, timeout=20), []

    def work(name: str) -> str:
        both.wait()
        if name == "b":
            raise ValueError(name)
        done.append(name)
        return name.upper()

    assert family_registry.side_by_side(lambda n: (both.wait(), n)[1], ["x", "y"]) == ["x", "y"]
    with pytest.raises(ValueError, match="b"):
        family_registry.side_by_side(work, ["b", "a"])
    assert done == ["a"]


def test_prefixes_are_set_on_arrow_values():
    """A batch larger than what is held as Python objects comes back whole and in order, nulls included."""
    n = 2 * compose.PROGRAMS + 3
    lines = pa.array([None if i == 5 else [f"b{i} = NOT(IN=c)", "x := b", None] for i in range(n)], pa.list_(pa.string()))
    names = pa.array([[f"b{i}", "c"] for i in range(n)], pa.list_(pa.string()))
    out = compose._prefixed.func(lines, names, pa.array(["a_"] * n))
    assert isinstance(out, pa.Array)
    assert out.to_pylist() == [None if i == 5 else [f"a_b{i} = NOT(IN=a_c)", "x := b", None] for i in range(n)]
    assert len(compose._prefixed.func(lines[:0], names[:0], pa.array([], pa.string()))) == 0


def test_joined_view_has_bounded_tasks(spark, sf, monkeypatch):
    """Orders are dealt out before programs are made of them."""
    monkeypatch.setattr(bindings, "ROWS_A_TASK", 4)
    orders = bindings.table(spark, sf, "orders").count()
    plan = registry.QUERIES["joined_view"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert f"RoundRobinPartitioning({-(-orders // 4)})" in plan
