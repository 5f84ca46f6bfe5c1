"""Comparison of a query with its DuckDB SQL."""

from __future__ import annotations

import glob
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[-1].removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def same(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    want = Counter(tuple(plain(r[columns.index(n)]) for n in names) for r in found.fetchall())
    assert got == want
