"""Compare a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if hasattr(value, "item"):
        return repr(value.item())
    if isinstance(value, bool) or value is None:
        return repr(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str, shown: int = 3) -> str | None:
    """None when both hold the same rows, else a short account of the difference."""
    found_columns = df.columns
    found = rows_of(found_columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    wanted_columns = [d[0] for d in result.description]
    wanted = rows_of(wanted_columns, result.fetchall())
    if sorted(found_columns) != sorted(wanted_columns):
        return f"columns {sorted(found_columns)} != {sorted(wanted_columns)}"
    if found == wanted:
        return None
    extra = sorted(set(found) - set(wanted))[:shown]
    missing = sorted(set(wanted) - set(found))[:shown]
    return f"{len(found)} rows, wanted {len(wanted)}\n only in Spark: {extra}\n only in SQL: {missing}"
