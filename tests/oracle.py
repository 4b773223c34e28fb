"""Compares a query's rows with those of its SQL."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    return x if x is None else str(x)


def rows(columns, values) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in values), key=repr)


def assert_same(df, con, sql: str) -> None:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cursor.fetchall())
