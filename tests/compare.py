"""Order-insensitive comparison of a Spark result with DuckDB on the same Parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def _plain(v):
    return str(v) if v is not None and not isinstance(v, (int, float, bool, str)) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, row count and values agree, else what differs first."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(set(names) ^ set(spark_df.columns))}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected, strict=True):
        if a != e:
            return f"first difference: {[(n, x, y) for n, x, y in zip(sorted(names), a, e) if x != y]}"
    return None
