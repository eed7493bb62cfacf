"""Comparing a Spark result with DuckDB's, value by value and regardless of row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([plain(row[i]) for i in at] for row in rows)


def spark_result(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duckdb_result(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())
