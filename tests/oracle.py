"""Compare a registered Spark query with its SQL on DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and value == 0:
        return 0.0  # one zero
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def differences(df, con, sql) -> list[str]:
    """Empty when names, row count, types and values are the same."""
    names, ours = spark_rows(df)
    expected_names, expected = sql_rows(con, sql)
    if names != expected_names:
        return [f"columns {names} != {expected_names}"]
    if len(ours) != len(expected):
        return [f"rows {len(ours)} != {len(expected)}", f"{ours[:2]}", f"{expected[:2]}"]
    out = []
    for a, b in zip(ours, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out += [f"{a!r:.600}", f"{b!r:.600}", ""]
    return out[:9]
