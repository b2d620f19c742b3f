"""Compare registered queries with their SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    return value


def _type(name: str) -> str:
    names = {"int": "integer", "string": "varchar", "timestamp_ntz": "timestamp"}
    return names.get(name, name)


def spark_rows(df) -> tuple[dict[str, str], Counter]:
    order = sorted(df.columns)
    kinds = {name: _type(kind) for name, kind in df.dtypes}
    rows = Counter(tuple(_plain(row[c]) for c in order) for row in df.select(*order).collect())
    return {name: kinds[name] for name in order}, rows


def duck_rows(connection, sql: str) -> tuple[dict[str, str], Counter]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    kinds = [str(column[1]).lower() for column in cursor.description]
    places = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in places) for row in cursor.fetchall())
    return {names[i]: kinds[i] for i in places}, rows
