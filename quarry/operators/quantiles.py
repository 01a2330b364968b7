"""Exact quantiles of large columns, and mergeable sketches of them.

A rank is found by refining histograms: a pass counts the rows of every interval still in question in ``BINS`` equal
parts, keeping each part's own smallest and largest value, and the part that holds the rank is the next interval. An
interval is done when it holds one value. Every pass is a partial aggregate of a few thousand rows; no task ever holds
a column, or its distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024


def at_ranks(df: DataFrame, col: str, ranks: Sequence[int], bins: int = BINS) -> dict[int, float]:
    """The values at the given places (from 0) of the column in ascending order; nulls and NaN are left out."""
    x = F.col(col).cast("double")
    rows = df.select(x.alias("x")).where("x is not null and not isnan(x)")
    first = rows.agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    # the ranks still to be found in each interval, and how many rows lie before it
    open_: dict[tuple, tuple[list[int], int]] = {}
    found: dict[int, float] = {}

    def put(low: float, high: float, before: int, some: list[int]) -> None:
        if low == high:
            found.update(dict.fromkeys(some, low))
        elif some:
            open_[(low, high)] = some, before

    put(first["low"], first["high"], 0, [r for r in set(ranks) if 0 <= r < first["n"]])
    while open_:
        now, open_ = sorted(open_.items()), {}
        which, part = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, ((low, high), _) in enumerate(now):
            here = (F.col("x") >= low) & (F.col("x") <= high)
            which = F.when(here, F.lit(i)).otherwise(which)
            # halved first, so that no difference overflows; infinities are parts of their own
            width = _end(high) / 2 - _end(low) / 2
            share = (F.col("x") / 2 - _end(low) / 2) / width * (bins - 2) if width else (F.col("x") > low).cast("double")
            inside = F.when(F.col("x") == float("-inf"), 0).when(F.col("x") == float("inf"), bins - 1).otherwise(
                F.greatest(F.lit(1), F.least(F.lit(bins - 2), F.floor(share).cast("int") + 1)))
            part = F.when(here, inside).otherwise(part)
        counted = (rows.select("x", which.alias("which"), part.alias("part")).where("which is not null")
                   .groupBy("which", "part").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
                   .orderBy("which", "low").collect())
        for i, (_, (some, before)) in enumerate(now):
            for r in (r for r in counted if r["which"] == i):
                put(r["low"], r["high"], before, [k for k in some if before <= k < before + r["n"]])
                before += r["n"]
    return found


def _end(x: float) -> float:
    return max(-1.7976931348623157e308, min(1.7976931348623157e308, x))


def quantiles(df: DataFrame, col: str, shares: Sequence[float], n: int | None = None) -> list[float | None]:
    """Exact quantiles, interpolated between the two nearest values as pandas does; None for an empty column."""
    if n is None:
        n = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).count()
    if not n:
        return [None] * len(shares)
    places = [s * (n - 1) for s in shares]
    values = at_ranks(df, col, [k for p in places for k in (math.floor(p), math.ceil(p))])
    out = []
    for p in places:
        a, b = values[math.floor(p)], values[math.ceil(p)]
        out.append(a if a == b else a + (b - a) * (p - math.floor(p)))
    return out


# ---------------------------------------------------------------------------------------------------------
# sketches: small values that are stored beside a part of the data and merged later


def distinct_sketch(col: str, log_size: int = 12) -> Column:
    """An aggregate: a sketch of the column's distinct values (binary, about 2^``log_size`` bytes; relative error about
    0.8 / sqrt(2^``log_size``))."""
    return F.hll_sketch_agg(F.col(col), F.lit(log_size))


def merged_distinct(sketch: str) -> Column:
    """An aggregate over sketches of one size: the number of distinct values of all their parts together."""
    return F.hll_sketch_estimate(F.hll_union_agg(F.col(sketch)))


def quantile_sketch(col: str, size: int = 400) -> Column:
    """An aggregate: a sketch of a numeric column's order (binary; rank error about 1 / ``size``)."""
    return F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(size))


def merged_quantiles(parts: DataFrame, sketch: str, shares: Sequence[float]) -> DataFrame:
    """One row with ``share`` and ``value`` for each share, from all sketches of ``parts`` merged."""
    whole = parts.agg(F.kll_merge_agg_double(F.col(sketch)).alias("s"))
    return whole.select(F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double(
        "s", F.lit(float(s))).alias("value")) for s in shares])).alias("q")).select("q.*")
