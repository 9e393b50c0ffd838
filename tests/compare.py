"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    return {"varchar": "string", "integer": "int"}.get(dtype, dtype)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """What differs between the two results, or None."""
    relation = con.sql(sql)
    ours = {name: _kind(dtype) for name, dtype in spark_df.dtypes}
    theirs = {name: _kind(str(dtype)) for name, dtype in zip(relation.columns, relation.types)}
    if ours != theirs:
        return f"schemas differ: {ours} / {theirs}"
    left = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    right = _rows(relation.columns, relation.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows / {len(right)} rows"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}" if wrong else None


def plan(spark_df) -> str:
    return spark_df._jdf.queryExecution().executedPlan().toString()
