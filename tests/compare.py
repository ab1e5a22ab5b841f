"""Compare a query with its oracle statement, row by row."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def open_oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda place: names[place])
    return Counter(tuple(_plain(row[place]) for place in order) for row in rows)


def differences(query, sql: str, spark, folder: str, connection) -> str | None:
    """None when equal, else a short account of what differs."""
    df = query(spark, folder)
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    left, right = _rows(df.columns, df.collect()), _rows(names, result.fetchall())
    if left == right:
        return None
    only_left, only_right = list((left - right).elements()), list((right - left).elements())
    return (
        f"{sum(left.values())} rows against {sum(right.values())}; columns {sorted(names)}; "
        f"only in query {len(only_left)}: {only_left[:2]}; only in oracle {len(only_right)}: {only_right[:2]}"
    )
