"""Every registered query against its check, on the smallest data."""

from __future__ import annotations

import pytest

from shelfmark.queries import ORACLES, QUERIES
from tests.compare import actual, connect, expected

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got_columns, got, _ = actual(spark, SF_DIR, name)
    if name in ORACLES:
        want_columns, want, _ = expected(con, name)
        assert got_columns == want_columns
        assert got == want


def test_no_query_plans_a_product(spark):
    for name, run in QUERIES.items():
        plan = run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
