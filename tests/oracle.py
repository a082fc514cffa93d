"""Comparison of a query with its SQL, as sorted text rows."""

from __future__ import annotations

import math
import os

import duckdb


def connected(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def shown(v) -> str:  # noqa: ANN001
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(shown, v)) + "]"
    return str(v)


def rows_of(df) -> tuple[list[str], list[tuple]]:  # noqa: ANN001
    columns = sorted(df.columns)
    return columns, sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, sorted(tuple(shown(r[k]) for k in at) for r in result.fetchall())
