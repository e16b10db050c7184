"""Every registered query against its SQL, on the smallest tables."""

import pytest

from starloom.slate import load_all
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, _, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), FOLDER)
    assert problem is None


def test_all_have_sql():
    assert set(ORACLES) == set(QUERIES)


def test_cube_forms_agree(spark):
    forms = [
        sorted(map(repr, QUERIES[name](spark, FOLDER).select("month", "country", "grouping_id", "revenue").collect()))
        for name in ("grouping_sets_sales", "cube_sales", "union_sales")
    ]
    assert forms[0] == forms[1] == forms[2]
