"""No registered query crosses tables, runs Python row by row or puts rows into one window."""

import pytest

from starloom.slate import load_all

FOLDER = "/root/testdata/sf0.001"
QUERIES, _ = load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for shape in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "CollectLimit"):
        assert shape not in plan
    # The only window over a whole result orders groups of key buckets, see add_dense_keys.
    windows = [x for x in plan.splitlines() if "Window [" in x and "_bucket" not in x and "_group" not in x]
    assert not [x for x in windows if _no_partition(x)]


def _no_partition(line):
    """A window without partition keys prints an order first, such as ``x#1 ASC``."""
    first = line.split("windowspecdefinition(")[1].split(",")[0]
    return " ASC" in first or " DESC" in first
