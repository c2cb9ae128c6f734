"""Run named queries next to their SQL and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duckdb_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        return ("n", str(value.normalize()) if value else "0")
    if isinstance(value, int):
        return ("n", str(decimal.Decimal(value).normalize()) if value else "0")
    if isinstance(value, float):
        return ("f", None if math.isnan(value) else round(value, 9))
    if isinstance(value, datetime.datetime):
        return ("t", value.replace(tzinfo=None))
    if isinstance(value, (list, tuple)):
        return tuple(_value(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, sf_dir: str) -> tuple[int, str]:
    """(rows, problem); the problem is empty when the results agree."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return sum(got.values()), f"columns {sorted(frame.columns)} != {sorted(names)}"
    if got != want:
        extra = list((got - want).items())[:2]
        lacking = list((want - got).items())[:2]
        return sum(got.values()), f"{sum(got.values())} vs {sum(want.values())} rows; extra {extra}; lacking {lacking}"
    return sum(got.values()), ""
