"""Order-insensitive comparison of a Spark result with DuckDB over the same Parquet files."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(directory: str):
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, Decimal):
        return "decimal"
    return type(value).__name__


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal; otherwise what differs first."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    if sorted(sql_names) != names:
        return f"columns {names} against {sorted(sql_names)}"
    order = [sql_names.index(n) for n in names]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=_key)
    rows = sorted((tuple(row[n] for n in names) for row in spark_df.collect()), key=_key)
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    for a, b in zip(rows, expected):
        for n, x, y in zip(names, a, b):
            if _kind(x) != _kind(y):
                return f"{n}: {x!r} against {y!r} in {a} / {b}"
            if isinstance(x, float) and math.copysign(1, x) != math.copysign(1, y) and x == 0:
                return f"{n}: sign of zero"
            if x != y:
                return f"{n}: {x!r} against {y!r}\n  spark {dict(zip(names, a))}\n  sql   {dict(zip(names, b))}"
    return None
