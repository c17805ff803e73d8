"""Side-by-side comparison of a Spark result and its SQL twin in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, row count, types that reach Python and exact values agree."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    found = df.collect()
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    problems = []
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    left, right = _bag(df.columns, found), _bag(columns, expected)
    for side, extra in (("only spark", left - right), ("only sql", right - left)):
        problems += [f"{side}: {row}" for row in list(extra)[:3]]
    kinds = [
        {c: type(r[i]).__name__ for r in rows for i, c in enumerate(names) if r[i] is not None}
        for names, rows in ((df.columns, found), (columns, expected))
    ]
    problems += [f"type of {c}: {k} != {kinds[1].get(c)}" for c, k in kinds[0].items() if kinds[1].get(c) != k]
    return problems
