"""Row-by-row comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def rows(columns: list[str], tuples) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(t[i]) for i in order) for t in tuples]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, in words; None when names, types and values agree exactly."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {c: (k, kinds[c]) for c, k in df.dtypes if KINDS[k] != kinds[c]}
    if wrong:
        return f"types differ: {wrong}"
    actual = rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    columns = sorted(names)
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if not bad:
        return None
    first = {c: (x, y) for c, x, y in zip(columns, *bad[0]) if x != y}
    return f"{len(bad)} of {len(actual)} rows differ, first: {first}"
