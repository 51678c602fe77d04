"""Run registered queries against their SQL on DuckDB and report differences.

    python -m tests.compare [--dir DIR] [name …]
"""

from __future__ import annotations

import argparse
import math
import os
import time
from datetime import datetime
from decimal import Decimal

import duckdb

import __spark_entry__ as contract
from crmflow.session import local_session

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            connection.execute(
                f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{name}')"
            )
    return connection


def plain(value):
    """A value as both engines can write it."""
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else repr(number + 0.0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return str(sorted((plain(k), plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """Empty text if the results agree, otherwise what differs."""
    df = contract.queries()[name](spark, sf_dir)
    ours = [tuple(row) for row in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return "" if ours else "no rows"
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    left, right = rows_of(df.columns, ours), rows_of(columns, theirs)
    if left == right:
        return "" if left else "no rows"
    differing = [(a, b) for a, b in zip(left, right) if a != b][:3]
    shown = [
        [(c, x, y) for c, x, y in zip(sorted(columns), a, b) if x != y][:6] for a, b in differing
    ]
    return f"rows {len(left)} vs {len(right)}; {shown}"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default=DEFAULT_DIR)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, connection = local_session(), connect(args.dir)
    failed = 0
    for name in args.names or contract.queries():
        started = time.time()
        try:
            problem = compare(spark, connection, args.dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        checked = "sql" if name in contract.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {checked:4} {time.time() - started:6.2f}s {name} {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
