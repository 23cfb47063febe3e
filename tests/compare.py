"""Run a registered query and its oracle and compare schema, row count and values."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    columns = []
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.dt.strftime("%Y-%m-%d %H:%M:%S.%f")
        columns.append(["" if pd.isna(v) else _text(v) for v in column.tolist()])
    return sorted(zip(*columns)) if columns else []


def _text(value) -> str:
    if isinstance(value, (bool, str)):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    if isinstance(value, date):
        return pd.Timestamp(value).strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(value)


SPARK_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def differences(query, sql: str, spark, sf_dir: str, connection) -> list[str]:
    found = query(spark, sf_dir)
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    wanted_types = {row[0]: SPARK_TYPES.get(row[1], row[1]) for row in described}
    problems = []
    if dict(found.dtypes) != wanted_types:
        wrong = {
            n: (dict(found.dtypes).get(n), wanted_types.get(n))
            for n in {*dict(found.dtypes), *wanted_types}
            if dict(found.dtypes).get(n) != wanted_types.get(n)
        }
        problems.append(f"schema (spark, oracle): {wrong}")
    ours, theirs = _rows(found.toPandas()), _rows(connection.execute(sql).fetchdf())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows, oracle has {len(theirs)}")
    elif ours != theirs:
        first = next((a, b) for a, b in zip(ours, theirs) if a != b)
        problems.append(f"values, first difference {first}")
    return problems
