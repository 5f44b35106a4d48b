"""Compare a query with its SQL on the same parquet files."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def check_plan(name: str, df) -> None:
    """No pair-wise join; groups of two tables meet in one task only where that is the way asked for."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "CoGroup" not in plan or name == "knn_exact"


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    if isinstance(value, (int, float)):
        number = float(value)
        return "nan" if math.isnan(number) else f"{number:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names and rows agree, else a short description."""
    rows = [tuple(r) for r in spark_df.collect()]
    relation = con.sql(sql)
    expected = relation.fetchall()
    if sorted(spark_df.columns) != sorted(relation.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(relation.columns)}"
    kinds = {c: _kind(t) for c, t in spark_df.dtypes}
    wanted = {c: _kind(str(t).lower()) for c, t in zip(relation.columns, relation.types)}
    if kinds != wanted:
        return f"types {[(c, kinds[c], wanted[c]) for c in kinds if kinds[c] != wanted[c]]}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)} rows"
    mine, theirs = normal(spark_df.columns, rows), normal(relation.columns, expected)
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def _kind(name: str) -> str:
    names = {"varchar": "string", "integer": "int", "timestamp": "timestamp_ntz", "tinyint": "int", "hugeint": "hugeint"}
    return names.get(name, name)
