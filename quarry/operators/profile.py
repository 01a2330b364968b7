"""Profiling and cleaning operators. Every summary is one pass of
partial + final aggregation; nothing is collected except one-row results the caller asks for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.quantiles import quantiles

_FLOATS = (T.FloatType, T.DoubleType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _missing(df: DataFrame, c: str) -> Column:
    """pandas-style missing: null, or NaN for floating columns."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, _FLOATS):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_counts(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """A2: ``(column, nulls)`` in one pass; by default only the columns that have any."""
    cols = df.columns
    wide = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "nulls")
    return long.where(F.col("nulls") > 0) if only_missing else long


def drop_missing_report(df: DataFrame, subset: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows without any missing value, report). The report has one row per column with missing values
    plus ``rows_before``, ``rows_removed``, ``rows_after`` — all from a single aggregate pass."""
    cols = list(subset or df.columns)
    any_missing = F.lit(False)
    for c in cols:
        any_missing = any_missing | _missing(df, c)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), F.count_if(any_missing).alias("_bad"),
                  *[F.count_if(_missing(df, c)).alias(c) for c in cols])
    long = wide.unpivot(["_rows", "_bad"], cols, "column", "nulls").where(F.col("nulls") > 0)
    report = long.select("column", "nulls", F.col("_rows").alias("rows_before"),
                         F.col("_bad").alias("rows_removed"), (F.col("_rows") - F.col("_bad")).alias("rows_after"))
    clean = df.where(~any_missing)
    return clean, report


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls per column with a constant."""
    return df.na.fill(dict(values))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """``(value, count)`` descending by count, ties by value; nulls skipped as in pandas."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), col)


def ordered_counts(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Counts for a fixed list of categories, in that order, zero for absent ones.
    The category list is a literal (bounded by the caller), so it is broadcast."""
    spark = df.sparkSession
    cats = spark.createDataFrame([(i, v) for i, v in enumerate(order)], f"position int, {col} string")
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return (counts.join(F.broadcast(cats), col, "right")
            .select("position", col, F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def group_means(df: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A10 / V8: mean of every numeric column per group (text columns are skipped, see SURVEY quirk 3)."""
    cols = list(cols) if cols else numeric_columns(df, exclude=[key])
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def describe(df: DataFrame, col: str) -> DataFrame:
    """pandas' eight numbers, percentiles exact and interpolated, found by refining histograms
    (:mod:`quarry.operators.quantiles`): no task holds the column. One row, also for an empty column."""
    rows = df.select(F.col(col)).where(F.col(col).isNotNull())
    n = rows.count()
    q = [F.lit(x).cast("double") for x in quantiles(rows, col, (0.25, 0.5, 0.75), n)]
    return rows.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                    F.min(col).alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"),
                    F.max(col).alias("max"))


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """L1 / L2 / L3: ordered first n rows (planned as TakeOrdered, n rows per task)."""
    return df.orderBy(*order).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """A1: ``(rows, columns)``."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))
