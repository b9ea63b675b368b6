"""Every registered query of the package on the smallest tables: against its check in SQL, or its row count."""

from __future__ import annotations

import duckdb
import pytest

from shelfmark.llm.queries import ORACLES, QUERIES
from tests.compare import rows_of

SF = "/root/testdata/sf0.001"
TABLE = {"op5_embedding_dedup": "embeddings"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_best_fit_packing"}))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    out = QUERIES[name](spark, SF)
    columns, got = rows_of(out.columns, [tuple(r) for r in out.collect()])
    if name in ORACLES:
        result = con.execute(ORACLES[name])
        assert (columns, got) == rows_of([c[0] for c in result.description], result.fetchall())
    else:
        assert len(got) == con.execute(f"SELECT count(*) FROM {TABLE.get(name, 'documents')}").fetchone()[0]


def test_no_products(spark):
    for name, run in QUERIES.items():
        plan = run(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
