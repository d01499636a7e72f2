"""Comparison of a query's rows with those of its DuckDB oracle."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str):
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return c


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(None if r[i] != r[i] else r[i] for i in order) for r in data), key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark_df, con, sql: str) -> str:
    """Empty if both have the same columns and rows."""
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    theirs = rows(columns, found.fetchall())
    ours = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, such as {bad[:2]}" if bad else ""
