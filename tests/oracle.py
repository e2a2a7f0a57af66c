"""Compare registered queries with their SQL in DuckDB: ``python -m tests.oracle [names...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("dec", format(value, "f"))
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, datetime):
        return ("ts", value.isoformat())
    if isinstance(value, date):
        return ("date", value.isoformat())
    if isinstance(value, (bytes, bytearray, memoryview)):
        return ("bytes", bytes(value).hex())
    if hasattr(value, "asDict"):
        return tuple(norm(v) for v in value)
    if isinstance(value, dict):
        return tuple(norm(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(norm(row[i]) for i in order) for row in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    columns, got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    expected_columns, expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if not expected:
        return None if not got else "expected no rows"
    if got != expected:
        extra, missing = list((got - expected).items())[:2], list((expected - got).items())[:2]
        return f"{sum(got.values())} rows vs {sum(expected.values())}\n   extra   {extra}\n   missing {missing}"[:1500]
    return None


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from dictspark.session import local_session

    sf = os.environ.get("SF", "0.01")
    sf_dir = f"{TESTDATA}/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [q for q in queries if not names or any(q.startswith(n) for n in names)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as error:
            problem = "".join(traceback.format_exception_only(error))[:1500]
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s{'' if name in oracles else ' (rows only)'}", flush=True)
        if problem:
            print("   " + problem, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
