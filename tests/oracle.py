"""Run registered queries against their SQL twins in DuckDB.

Usage: python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None if both results hold the same rows, else what differs."""
    columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected_columns, expected = _rows(names, found.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    if not got:
        return "no rows"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ in {columns}, first: spark {wrong[0][0]} sql {wrong[0][1]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from perilspark.session import build_session

    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        started = time.time()
        try:
            if name in oracles:
                problem = compare(queries[name](spark, args.sf), con, oracles[name])
            else:
                problem = None if queries[name](spark, args.sf).count() else "no rows"
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:26s} {time.time() - started:6.2f}s {'' if name in oracles else '(rows only) '}{problem or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
