"""Run registered queries in Spark and their checks in DuckDB, and compare the rows.

python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

from shelfmark.queries import ORACLES, QUERIES
from shelfmark.queries.views import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value.is_integer() else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    listed = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(listed, key=repr)


def expected(con, name):
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    return (*rows_of(columns, result.fetchall()), kinds)


def actual(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    return (*rows_of(df.columns, [tuple(r) for r in df.collect()]), dict(df.dtypes))


def main(argv):
    from tests.conftest import local_session

    sf = argv[argv.index("--sf") + 1] if "--sf" in argv else "0.01"
    names = [a for a in argv if not a.startswith("--") and a != sf] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            got_cols, got, got_kinds = actual(spark, sf_dir, name)
        except Exception as failure:
            bad += 1
            print(f"FAIL {name}: {str(failure)[:600]}")
            continue
        seconds = time.time() - begin
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows, {seconds:.1f}s")
            continue
        try:
            want_cols, want, want_kinds = expected(con, name)
        except Exception as failure:
            bad += 1
            print(f"FAIL {name} (check): {str(failure)[:600]}")
            continue
        same = got_cols == want_cols and got == want
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(got)} / {len(want)} rows, {seconds:.1f}s")
        kinds = {c: (got_kinds[c], want_kinds.get(c)) for c in got_cols}
        odd = {
            c: k for c, k in kinds.items()
            if (k[0], k[1]) not in {
                ("string", "VARCHAR"), ("bigint", "BIGINT"), ("int", "INTEGER"),
                ("double", "DOUBLE"), ("boolean", "BOOLEAN"),
            }
        }
        if odd:
            print("     types:", odd)
        if not same:
            print("     columns:", got_cols, want_cols)
            left, right = set(map(repr, got)), set(map(repr, want))
            for label, extra in (("spark", left - right), ("sql", right - left)):
                for row in sorted(extra)[:3]:
                    print(f"     only {label}: {row[:400]}")
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
