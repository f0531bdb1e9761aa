"""Spark result against its SQL twin."""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and the same rows, as often."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    wanted = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == wanted:
        return None
    only_spark, only_sql = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows / {sum(wanted.values())}; {sum(only_spark.values())} only in "
        f"Spark, {sum(only_sql.values())} only in SQL\ncolumns {sorted(names)}\n"
        f"spark {list(only_spark)[:3]}\nsql   {list(only_sql)[:3]}"
    )
