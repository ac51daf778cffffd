"""Compare a Spark result with its SQL on DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else a description of the first difference."""
    spark_columns, spark_rows = _sorted(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_columns, duck_rows = _sorted([c[0] for c in result.description], result.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} / {duck_columns}"
    if len(spark_rows) != len(duck_rows):
        return f"row counts {len(spark_rows)} / {len(duck_rows)}"
    for left, right in zip(spark_rows, duck_rows):
        if left != right:
            names = [(c, a, b) for c, a, b in zip(spark_columns, left, right) if a != b]
            return f"differences {names[:6]} in {left[:4]}"
    return None
