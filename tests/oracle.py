"""Compare every registered query with its SQL.

    python tests/oracle.py [directory] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

TESTDATA = os.environ.get("TOUCHLINE_TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return repr(v)
    return str(v)


def _rows(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the frame and the SQL give the same columns and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = _rows(df.columns, df.collect())
    want = _rows(names, expected)
    if not got:
        return "no rows at all"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL gives {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"got {g}, SQL gives {w}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from touchline.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else f"{TESTDATA}/sf0.01"
    spark = local_session(8)
    con = connect(sf_dir)
    queries, sqls = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = differences(df, con, sqls[name]) if name in sqls else None if df.count() >= 0 else "?"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
