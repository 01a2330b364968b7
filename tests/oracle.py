"""Spark-vs-DuckDB comparison used by the tests (same idea as the external correctness gate):
columns sorted by name, floats rounded to 6 places, rows compared as an order-insensitive multiset."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from quarry.plans.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm_value(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm_value(v.item())
        except (ValueError, AttributeError):
            pass
    return v


def normalise(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm_value(v) for v in row) for row in pdf[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    left = spark_df.toPandas()
    right = con.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    a, b = normalise(left), normalise(right)
    if len(a) != len(b):
        return False, f"row counts differ: spark {len(a)} vs duckdb {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return False, f"{len(diff)} rows differ, first: {diff[0]}"
    return True, f"{len(a)} rows equal"
