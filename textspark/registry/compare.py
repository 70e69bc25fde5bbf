"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def difference(
    spark: SparkSession, con, sf_dir: str, query: Callable[[SparkSession, str], DataFrame], sql: str
) -> str:
    """Empty if names and all values agree exactly, otherwise what differs first."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{str(a)[:300]} against {str(b)[:300]}"
    return ""
