"""Feature encoding: label codes, drop-first one-hot, standardisation, centred PCA.

Fitted statistics are small *models* (one value per class, category or feature dimension), computed by one
distributed aggregate and applied as literal Column expressions — the way ``pyspark.ml`` models carry
their parameters — so applying them needs no join at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import stored


# ---------------------------------------------------------------------------------------------------------
# Label encoding


def label_classes(df: DataFrame, col: str) -> DataFrame:
    """``(class, code)``, codes 0.. in alphabetical order (the reference's encoder; Spark's
    StringIndexer defaults to frequency order). The window runs over the distinct classes only."""
    classes = df.select(F.col(col).alias("class")).where(F.col("class").isNotNull()).distinct()
    return classes.select("class", (F.row_number().over(Window.orderBy("class")) - 1).cast("int").alias("code"))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(frame with ``out`` = code of ``col``, class table). The class table is stored, so the join back
    broadcasts it or not by its size in bytes."""
    classes = stored(label_classes(df, col), "classes")
    lookup = classes.withColumnRenamed("class", col).withColumnRenamed("code", out or f"{col}_code")
    return df.join(lookup, col, "left"), classes


# ---------------------------------------------------------------------------------------------------------
# One-hot, first category dropped


def text_columns(df: DataFrame, besides: Sequence[str] = ()) -> list[str]:
    """The string columns of ``df``, which drop-first one-hot encodes when no list is given."""
    return [c for c, kind in df.dtypes if kind == "string" and c not in besides]


def categories(df: DataFrame, col: str, max_categories: int) -> list:
    """Sorted distinct non-null values of a categorical column: they become the schema of a wide encoding, so the
    caller states how many columns are acceptable. More raise an error; :func:`onehot_long` has no such bound."""
    vals = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_categories + 1).collect()
    if len(vals) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories; use the long or vector form")
    return sorted(r[0] for r in vals)


def onehot_drop_first(df: DataFrame, cols: Sequence[str], max_categories: int) -> DataFrame:
    """E2 (wide, as ``get_dummies(drop_first=True)``): each text column becomes int 0/1 columns
    ``col_value`` for every value but the alphabetically first; a null is 0 in all of them; other columns pass
    through."""
    out = df
    for c in cols:
        vals = categories(df, c, max_categories)
        out = out.select("*", *[F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in vals[1:]]).drop(c)
    return out


def onehot_long(df: DataFrame, key_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """E2 (long): ``(key..., feature, value=1)`` rows for every set category — no schema from data."""
    stacked = df.select(*key_cols, F.explode(F.array(*[
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}_"), F.col(c).cast("string"))) for c in cols])).alias("feature"))
    return stacked.where(F.col("feature").isNotNull()).withColumn("value", F.lit(1))


def onehot_vector(df: DataFrame, col: str, out: str) -> DataFrame:
    """E2 (vector): one place for every category but the alphabetically first, in descending order of the alphabet;
    the first category, nulls and values unseen when fitted are the zero vector. The indexer's two last places (first
    category, unknown) are cut off."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorSlicer

    idx = StringIndexer(inputCol=col, outputCol=f"{col}__idx", stringOrderType="alphabetDesc", handleInvalid="keep")
    indexer = idx.fit(df)
    enc = OneHotEncoder(inputCol=f"{col}__idx", outputCol=f"{col}__all", dropLast=False)
    keep = VectorSlicer(inputCol=f"{col}__all", outputCol=out, indices=list(range(max(0, len(indexer.labels) - 1))))
    return Pipeline(stages=[indexer, enc, keep]).fit(df).transform(df).drop(f"{col}__idx", f"{col}__all")


# ---------------------------------------------------------------------------------------------------------
# Standardisation with the population standard deviation


@dataclass
class Scaler:
    """Fitted means and population standard deviations (0 → 1, as the reference's scaler)."""

    cols: list[str]
    means: list[float]
    stds: list[float]

    def transform(self, df: DataFrame, prefix: str = "z_") -> DataFrame:
        return df.select("*", *[((F.col(c) - F.lit(m)) / F.lit(s)).alias(prefix + c)
                                for c, m, s in zip(self.cols, self.means, self.stds)])


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """E4/E5 fit: one aggregate pass (``ml.feature.StandardScaler`` would use the sample std)."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    means = [float(row[f"m{i}"]) for i in range(len(cols))]
    stds = [float(row[f"s{i}"]) or 1.0 for i in range(len(cols))]
    return Scaler(list(cols), means, stds)


@dataclass
class ArrayScaler:
    """Per-dimension standardisation of an ``array<float|double>`` feature column."""

    col: str
    means: list[float]
    stds: list[float]

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        m = F.array(*[F.lit(x) for x in self.means])
        s = F.array(*[F.lit(x) for x in self.stds])
        z = F.transform(F.col(self.col), lambda x, i: (x.cast("double") - m[i]) / s[i])
        return df.withColumn(out, z)


def _dimension_stats(df: DataFrame, col: str, with_std: bool = True) -> tuple[list[float], list[float]]:
    """Per-dimension mean (and population std) of an array column: one ``groupBy(dimension)`` with partial
    aggregation; the result (one row per dimension) is the fitted model."""
    long = df.select(F.posexplode(col).alias("_i", "_x")).select("_i", F.col("_x").cast("double").alias("_x"))
    aggs = [F.avg("_x").alias("m")] + ([F.stddev_pop("_x").alias("s")] if with_std else [])
    rows = sorted(long.groupBy("_i").agg(*aggs).collect(), key=lambda r: r["_i"])
    means = [float(r["m"]) for r in rows]
    stds = [float(r["s"]) or 1.0 for r in rows] if with_std else []
    return means, stds


def fit_array_scaler(df: DataFrame, col: str) -> ArrayScaler:
    """Fit on an array column (dimension taken from the data)."""
    means, stds = _dimension_stats(df, col)
    return ArrayScaler(col, means, stds)


def to_vector(col: str | Column) -> Column:
    """``array<double>`` → dense ``VectorUDT`` for ``pyspark.ml``."""
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.col(col) if isinstance(col, str) else col)


# ---------------------------------------------------------------------------------------------------------
# PCA, centred, deterministic signs


def pca_2d(df: DataFrame, features: str, k: int = 2, out: str = "pca") -> DataFrame:
    """``out`` = the centred rows along the first ``k`` principal components, each component with its
    largest-magnitude loading positive (:mod:`quarry.operators.pca`: any number of columns, sparse or not)."""
    from quarry.operators import pca

    if dict(df.dtypes)[features] == "vector":
        return pca.project(df, features, *pca.directions(df, features, k), out)
    mean, found = pca.directions(df.withColumn("_v", to_vector(features)), "_v", k)
    return pca.project(df.withColumn("_v", to_vector(features)), "_v", mean, found, out).drop("_v")
