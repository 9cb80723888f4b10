"""Compare a query with its SQL counterpart on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df: DataFrame, sql: str, sf_dir: str) -> list[str]:
    """What differs, as text; empty if the results are the same."""
    ours = _rows(df.columns, df.collect())
    result = connect(sf_dir).execute(sql)
    names = [column[0] for column in result.description]
    theirs = _rows(names, result.fetchall())
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows != {len(theirs)} rows")
    found += [f"{a} != {b}" for a, b in zip(ours, theirs) if a != b][:3]
    return found
