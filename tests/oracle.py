"""Rows of a query and of its SQL in DuckDB, made comparable."""

import glob
import os

import duckdb

SF = "/root/testdata/sf0.001"


def duck(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"create view {os.path.basename(path).split('.')[0]} as select * from '{path}'")
    return con


def spark_rows(df) -> list[str]:
    names = sorted(df.columns)
    return sorted(str(tuple(r[n] for n in names)) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[str]]:
    found = con.sql(sql)
    names = sorted(found.columns)
    at = [found.columns.index(n) for n in names]
    return names, sorted(str(tuple(r[k] for k in at)) for r in found.fetchall())
