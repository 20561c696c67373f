"""Running the registered queries next to their SQL twins."""

from __future__ import annotations

import datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TYPE_NAMES = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (Decimal, float, bool)):
        return repr(value)
    return value


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_result(df):
    types = {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    return types, _sorted_rows([tuple(r) for r in df.collect()], df.columns)


def duckdb_result(connection, statement):
    cursor = connection.execute(statement)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]).lower() for d in cursor.description}
    return types, _sorted_rows(cursor.fetchall(), names)
