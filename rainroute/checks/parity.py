"""Run registered queries in Spark and their SQL in DuckDB and compare the results.

    python -m rainroute.checks.parity /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int",
    "bigint": "bigint", "double": "double", "varchar": "string", "string": "string",
    "date": "date", "boolean": "boolean", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted_rows(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def compare(con: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    kinds = {c[0]: KINDS.get(str(c[1]).lower(), str(c[1]).lower()) for c in cursor.description}
    expected = cursor.fetchall()
    got_kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if kinds != got_kinds:
        wrong = {c: (got_kinds.get(c), kinds.get(c)) for c in {*kinds, *got_kinds} if got_kinds.get(c) != kinds.get(c)}
        return f"schema (spark, duckdb): {wrong}"
    got = df.collect()
    if len(got) != len(expected):
        return f"rows: spark {len(got)}, duckdb {len(expected)}"
    left, right = _sorted_rows(df.columns, got), _sorted_rows(list(kinds), expected)
    for a, b in zip(left, right):
        if a != b:
            return f"values: spark {a} | duckdb {b}"
    return None


def main() -> int:
    from rainroute.checks.oracle import ORACLE
    from rainroute.checks.registry import REGISTRY
    from rainroute.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark, con, failures = local_session(8), connect(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            df = REGISTRY[name](spark, sf_dir)
            if name in ORACLE:
                problem = compare(con, ORACLE[name], df)
                status = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                status = f"rows only: {df.count()}"
        except Exception as error:  # report every query, then fail
            status = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failures += not status.startswith(("ok", "rows"))
        print(f"{name:32s} {time.time() - started:6.2f}s {status}", flush=True)
    print(f"{len(names)} queries, {failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
