"""Compare queries with their SQL: ``python tests/oracle.py FOLDER [NAME...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and value == 0:
        return 0.0  # no difference between the two zeros
    return None if isinstance(value, float) and math.isnan(value) else value


def _counted(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark's name of a type, and DuckDB's.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def compare(df, con, sql: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    expected = con.sql(sql)
    want_types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    have_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if want_types != have_types:
        return f"schema {have_types} instead of {want_types}"
    have = _counted(df.columns, [tuple(row) for row in df.collect()])
    want = _counted(expected.columns, expected.fetchall())
    if have != want:
        extra, missing = have - want, want - have
        return (
            f"{extra.total()} rows too many, e.g. {list(extra)[:2]}; "
            f"{missing.total()} missing, e.g. {list(missing)[:2]}"
        )
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidemill.session import build_session

    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tidemill-"),
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.perf_counter()
        try:
            df = run(spark, folder)
            problem = compare(df, con, oracles[name]) if name in oracles else None
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:26s} {time.perf_counter() - begin:6.1f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
