"""Order-insensitive comparison of a Spark result with its check SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def difference(con, df, sql: str) -> str | None:
    """None if both give the same rows, else a short description."""
    cursor = con.execute(sql)
    expected, names = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    actual, spark_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if names != spark_names:
        return f"columns {spark_names} != {names}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ, first spark={wrong[0][0]} sql={wrong[0][1]}" if wrong else None
