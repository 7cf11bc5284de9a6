"""Comparing a Spark result with what DuckDB returns for the checking SQL."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return str(value.normalize())
    return str(value)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(None if row[i] is None else _plain(row[i]) for i in order) for row in rows)


_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def spark_types(df) -> dict[str, str]:
    return {name: _TYPES.get(kind, kind.upper().replace(" ", "")) for name, kind in df.dtypes}


def oracle_types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1].replace(" ", "") for row in connection.execute(f"DESCRIBE {sql}").fetchall()}


def differences(df, connection, sql: str) -> str | None:
    """None when both agree in columns, types and rows; else what differs."""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = bag(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    ours, theirs = spark_types(df), oracle_types(connection, sql)
    if ours != theirs:
        return f"types {[(c, ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]]}"
    actual = bag(df.columns, df.collect())
    if actual == expected:
        return None
    return (
        f"{actual.total()} / {expected.total()} rows; "
        f"only here {list((actual - expected).items())[:3]}; only there {list((expected - actual).items())[:3]}"
    )
