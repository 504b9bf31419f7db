"""Compare a Spark frame with a DuckDB query, ignoring row and column order."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return format(Decimal(value).normalize(), "f") if value else "0"
    if isinstance(value, float):
        return format(Decimal(f"{value:.9g}").normalize(), "f") if value else "0"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    if hasattr(value, "asDict"):
        return _plain(value.asDict())
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, con, sql: str) -> str | None:
    """None when both hold the same rows, else a short account of what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    expected = _rows(result.fetchall(), names)
    actual = _rows(frame.collect(), frame.columns)
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
        f"{sum(extra.values())} extra such as {list(extra)[:2]}; "
        f"{sum(missing.values())} missing such as {list(missing)[:2]} (columns {sorted(names)})"
    )
