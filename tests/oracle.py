"""Compares a registered query with its SQL on the same tables."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in order."""

    def text(value: object) -> str:
        if pd.isna(value):
            return "NULL"
        if isinstance(value, float) and value.is_integer():
            return str(int(value))
        return str(value)

    ordered = frame[sorted(frame.columns)]
    texts = ordered.astype(object).map(text)
    return texts.sort_values(list(texts.columns)).reset_index(drop=True)


def differences(result: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    if sorted(result.columns) != sorted(expected.columns):
        return f"columns {sorted(result.columns)} != {sorted(expected.columns)}"
    if len(result) != len(expected):
        return f"rows {len(result)} != {len(expected)}"
    left, right = normalised(result), normalised(expected)
    if left.equals(right):
        return None
    rows = (left != right).any(axis=1)
    return f"{rows.sum()} rows differ:\n{left[rows].head(3)}\n{right[rows].head(3)}"
