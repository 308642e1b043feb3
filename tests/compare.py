"""Comparing a Spark query with its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def normalised(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return normalised(df.columns, [tuple(r) for r in df.collect()])
