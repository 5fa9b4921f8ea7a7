"""Order-insensitive comparison of a Spark result with DuckDB SQL on the same Parquet files."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_rows(df: DataFrame):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    return _rows([c[0] for c in result.description], result.fetchall())
