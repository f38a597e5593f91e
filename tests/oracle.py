"""Compare a query with DuckDB on the same tables."""

from __future__ import annotations

import os

import duckdb

from spotloom.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v)


def assert_same(df, con, sql: str) -> None:
    got = con.sql(sql)
    names = got.columns
    expected = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in got.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()) == expected
