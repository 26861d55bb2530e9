"""Compares a Spark result with the result of its SQL in DuckDB, value for value."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(found: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty when schema names, rows and values all agree."""
    expected = connection.execute(sql)
    names = [c[0] for c in expected.description]
    if sorted(names) != sorted(found.columns):
        return [f"columns {sorted(found.columns)} instead of {sorted(names)}"]
    columns = sorted(names)
    theirs = Counter(tuple(row[names.index(c)] for c in columns) for row in expected.fetchall())
    ours = Counter(tuple(row) for row in found.select(*columns).collect())
    out = []
    for label, rows in (("missing", theirs - ours), ("extra", ours - theirs)):
        if rows:
            out.append(f"{sum(rows.values())} {label} of {sum(theirs.values())}, such as {next(iter(rows))}")
    return out if out or theirs else ["no rows"]
