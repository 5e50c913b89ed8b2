"""Runs a query in Spark and its SQL in DuckDB, and compares the results as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with one view per test table."""
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def difference(spark, connection, query, sql: str, sf_dir: str) -> tuple[int, str]:
    """Row count and a description of what differs, empty if nothing does."""
    result = query(spark, sf_dir)
    names = sorted(result.columns)
    ours = Counter(tuple(row[n] for n in names) for row in result.collect())
    relation = connection.sql(sql)
    if sorted(relation.columns) != names:
        return sum(ours.values()), f"columns {names} against {sorted(relation.columns)}"
    theirs = Counter(relation.project(", ".join(f'"{n}"' for n in names)).fetchall())
    if ours == theirs:
        return sum(ours.values()), ""
    only_ours, only_theirs = ours - theirs, theirs - ours
    return sum(ours.values()), (
        f"{sum(only_ours.values())} only in Spark, {sum(only_theirs.values())} only in SQL; e.g. "
        f"{names}: {list(only_ours)[:2]} against {list(only_theirs)[:2]}"
    )
