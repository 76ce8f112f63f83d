"""Comparing a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def sort_key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) for v in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted((tuple(r) for r in df.select(*columns).collect()), key=sort_key)


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=sort_key)
    return [names[i] for i in order], rows
