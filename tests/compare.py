"""Rows of a query and of its SQL, in one form."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(x: object) -> str:
    return repr(0.0 if isinstance(x, float) and x == 0 else x)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, got.fetchall())
