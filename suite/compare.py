"""Run registered queries against their SQL and report differences.

Usage: python -m suite.compare [folder of the tables] [name part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from suite.oracles import ORACLES
from suite.queries import QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_dir, table)}.parquet'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def _same(a: object, b: object) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return type(a) is type(b) and a == b


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both results are equal in names, types and values, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_sortable)
    if name not in ORACLES:
        return None if ours else "no rows"
    result = con.execute(ORACLES[name])
    theirs_columns = [d[0] for d in result.description]
    if sorted(theirs_columns) != columns:
        return f"columns {columns} against {sorted(theirs_columns)}"
    places = [theirs_columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=_sortable)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"{dict(zip(columns, a))} against {dict(zip(columns, b))}"
    return None if ours else "no rows"


def main(arguments: list[str]) -> int:
    from tallyhouse.session import local_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:]
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in QUERIES:
        if wanted and not any(part in name for part in wanted):
            continue
        started = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name}", problem or "", flush=True)
    missing = sorted(set(QUERIES) - set(ORACLES))
    print(f"{failed} failed; without SQL: {missing}; SQL without query: {sorted(set(ORACLES) - set(QUERIES))}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
