"""Runs a query on Spark and its SQL on DuckDB and tells how the results differ."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value
    if isinstance(value, bool):
        return int(value)
    return value


def _ordered(columns: list[str], rows) -> list[tuple]:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in places) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _ordered(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _ordered(columns, cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None where both sides agree exactly, else a short account."""
    columns, rows = spark_rows(df)
    other_columns, other_rows = sql_rows(con, sql)
    if columns != other_columns:
        return f"columns {columns} != {other_columns}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)} rows"
    for row, other in zip(rows, other_rows):
        if row != other or any(type(a) is not type(b) for a, b in zip(row, other)):
            return f"columns {columns}\n  spark {row}\n  sql   {other}"
    return None
