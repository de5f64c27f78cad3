"""Order-insensitive comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


# Spark's type names for what DuckDB calls otherwise.
_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree in columns, types and rows, else what differs."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {r[0]: _TYPES.get(r[1], r[1]) for r in described}
    if dict(df.dtypes) != expected_types:
        return f"types {dict(df.dtypes)} against {expected_types}"
    cursor = con.execute(sql)
    expected = bag([r[0] for r in described], cursor.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    if got != expected:
        return (
            f"{sum(got.values())} rows against {sum(expected.values())}; "
            f"only in Spark {list((got - expected).items())[:3]}, "
            f"only in SQL {list((expected - got).items())[:3]}"
        )
    return None if expected else "no rows to compare"
