"""Compare registered queries with their SQL twins.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from millrace.plans.registry import TABLE_NAMES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0  # no negative zero
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Rows with their columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(con, df, sql: str) -> str | None:
    """None if equal, else what differs."""
    declared = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    described = {row[0]: str(row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    if declared != described:
        return f"columns and types {declared} against {described}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}"
    if not got[1]:
        return "no rows"
    different = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if different:
        return f"{len(different)} of {len(got[1])} rows differ, such as {different[0][0]} against {different[0][1]}"
    return None


def main() -> int:
    from __spark_entry__ import queries
    from millrace.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--folder", help="other tables than the given ones")
    parser.add_argument("--all", action="store_true", help="run the queries without SQL as well")
    args = parser.parse_args()
    folder = args.folder or f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), connect(folder)
    failed = 0
    for name, query in queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            if query.sql:
                problem = compare(con, query(spark, folder), query.sql)
            elif args.all or args.names:
                n = query(spark, folder).count()
                problem = None if n else "no rows"
            else:
                continue
        except Exception:
            problem = traceback.format_exc(limit=-3)[-1500:]
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - start:6.2f}s  {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
