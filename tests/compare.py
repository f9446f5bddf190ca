"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def normal(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(normal(x) for x in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(normal(v) for v in row) for row in df.select(*names).collect())


def sql_rows(con, sql):
    result = con.sql(sql)
    names = sorted(result.columns)
    order = [result.columns.index(n) for n in names]
    return names, Counter(tuple(normal(row[i]) for i in order) for row in result.fetchall())
