"""Repeatable sampling and splitting without row order and without one huge partition.

Every row gets a pseudo-random but repeatable position: ``md5(key | seed | purpose)``. The purpose keeps the operators
apart: a split of an undersampled table must not reuse the order that the undersampling cut. Keys must be unique; rows
that share a key share a place.

The exact rank of a row in that order (within its class, or globally) needs no window over a whole class:

1. bucket = the first ``DIGITS`` hex digits of the hash (4,096 buckets, whatever the size);
2. one pass counts rows per (class, bucket): a small table, stored, that gives class sizes, quotas and every bucket's
   offset by running sums;
3. for a quota, buckets wholly below or above it are decided without a shuffle; only the bucket that holds the boundary
   of its class is ranked by ``row_number``;
4. where a full rank is wanted, rank = offset + ``row_number()`` inside (class, bucket).

The bucket is a prefix of the hash, so bucket order agrees with hash order and the rank is exactly the one of a window
over the whole class. The same md5 expression runs in DuckDB, so every split is checked by SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import stored

RANK = "_rank"
DIGITS = 3


def hash_key(key_cols: Sequence[str], seed: int | str = 42, purpose: str = "") -> Column:
    """``md5('key1|key2|seed|purpose')`` as lowercase hex."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed)), F.lit(purpose)))


def _hashed(df: DataFrame, key_cols: Sequence[str], seed: int | str, purpose: str) -> DataFrame:
    return df.withColumn("_h", hash_key(key_cols, seed, purpose)).withColumn("_bucket", F.substring("_h", 1, DIGITS))


def bucket_offsets(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by..., _bucket, _n, _offset, _cnt)``: rows of the bucket, of the buckets before it, and of the class. One
    pass over the source; the result has at most 4,096 rows a class."""
    counts = stored(hashed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n")), "buckets")
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*by, "_bucket", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                         F.sum("_n").over(Window.partitionBy(*by)).alias("_cnt"))


def _attach(hashed: DataFrame, table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join the bucket table to the rows; a null class is a class."""
    names = [*by, "_bucket"]
    right = table.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(names)],
                         *[c for c in table.columns if c not in names])
    on = reduce(lambda a, b: a & b, [hashed[c].eqNullSafe(right[f"_r{i}"]) for i, c in enumerate(names)])
    return hashed.join(right, on).drop(*[f"_r{i}" for i in range(len(names))])


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed: int | str = 42, by: Sequence[str] = (),
              purpose: str = "rank") -> DataFrame:
    """Add ``_rank`` (1-based) = position of the row within its ``by`` group in (hash, key) order."""
    hashed = _hashed(df, key_cols, seed, purpose)
    offsets = stored(bucket_offsets(hashed, by).select(*by, "_bucket", "_offset"), "offsets")
    inside = Window.partitionBy(*by, "_bucket").orderBy("_h", *key_cols)
    return (_attach(hashed, offsets, by).withColumn(RANK, F.col("_offset") + F.row_number().over(inside))
            .drop("_h", "_bucket", "_offset"))


def _below(hashed: DataFrame, quotas: DataFrame, key_cols: Sequence[str], by: Sequence[str], out: str) -> DataFrame:
    """Add boolean ``out``: the row's rank is within its class's ``_quota``. Only boundary buckets are shuffled."""
    table = stored(quotas.select(*by, "_bucket", "_n", "_offset", "_quota"), "quotas")
    rows = _attach(hashed, table, by)
    end = F.col("_offset") + F.col("_n")
    edge = (F.col("_offset") < F.col("_quota")) & (end > F.col("_quota"))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_h", *key_cols)
    decided = rows.where(~edge).withColumn(out, end <= F.col("_quota"))
    ranked = rows.where(edge).withColumn(out, F.col("_offset") + F.row_number().over(inside) <= F.col("_quota"))
    return decided.unionByName(ranked).drop("_h", "_bucket", "_n", "_offset", "_quota")


def undersample(df: DataFrame, label_col: str, key_cols: Sequence[str], seed: int | str = 42) -> DataFrame:
    """Every class reduced to the size of the smallest class (the reference's majority → minority
    undersampling, for any number of classes). Rows with a null label belong to no class and are not drawn."""
    hashed = _hashed(df.where(F.col(label_col).isNotNull()), key_cols, seed, "undersample")
    offsets = bucket_offsets(hashed, [label_col])
    least = offsets.agg(F.min("_cnt")).first()[0] or 0
    kept = _below(hashed, offsets.withColumn("_quota", F.lit(least)), key_cols, [label_col], "_in")
    return kept.where("_in").drop("_in")


def shuffle_order(df: DataFrame, key_cols: Sequence[str], seed: int | str = 42) -> DataFrame:
    """L4: a repeatable permutation, exposed as ``shuffle_rank`` (rows have no order in Spark)."""
    return hash_rank(df, key_cols, seed, purpose="shuffle").withColumnRenamed(RANK, "shuffle_rank")


def _test_quota(counts: DataFrame, label_col: str, test_size: float) -> DataFrame:
    """Per class test size as the reference's stratified splitter: ``n_test = ceil(test_size·n)``, train
    sizes by largest remainder of ``cnt/n·n_train`` (ties → smaller label), test = the rest of the class.
    Runs on the class-count table (one row per class)."""
    whole = Window.partitionBy()
    c = counts.withColumn("_n", F.sum("_cnt").over(whole))
    c = c.withColumn("_n_test", F.ceil(F.lit(float(test_size)) * F.col("_n")))
    c = c.withColumn("_cont", F.col("_cnt") / F.col("_n") * (F.col("_n") - F.col("_n_test")))
    c = c.withColumn("_floor", F.floor("_cont"))
    c = c.withColumn("_need", F.col("_n") - F.col("_n_test") - F.sum("_floor").over(whole))
    by_remainder = Window.orderBy((F.col("_cont") - F.col("_floor")).desc(), label_col)
    c = c.withColumn("_pos", F.row_number().over(by_remainder))
    c = c.withColumn("_train", F.col("_floor") + F.when(F.col("_pos") <= F.col("_need"), 1).otherwise(0))
    return c.select(label_col, (F.col("_cnt") - F.col("_train")).alias("_quota"))


def stratified_split(df: DataFrame, label_col: str, key_cols: Sequence[str], test_size: float = 0.2,
                     seed: int | str = 42) -> DataFrame:
    """Adds ``split`` ∈ {train, test}; class proportions kept exactly as the reference's splitter; members chosen
    by hash rank within the class. Rows with a null label are kept, as a class of their own."""
    hashed = _hashed(df, key_cols, seed, "split")
    offsets = bucket_offsets(hashed, [label_col])
    quota = _test_quota(offsets.select(label_col, "_cnt").distinct(), label_col, test_size).withColumnRenamed(
        label_col, "_label")
    quotas = offsets.join(quota, offsets[label_col].eqNullSafe(quota["_label"])).drop("_label")
    out = _below(hashed, quotas, key_cols, [label_col], "_in")
    return out.withColumn("split", F.when(F.col("_in"), "test").otherwise("train")).drop("_in")


def plain_split(df: DataFrame, key_cols: Sequence[str], test_size: float = 0.2, seed: int | str = 42) -> DataFrame:
    """``ceil(test_size·n)`` rows by global hash rank go to test."""
    hashed = _hashed(df, key_cols, seed, "split")
    offsets = bucket_offsets(hashed, [])
    quotas = offsets.withColumn("_quota", F.ceil(F.lit(float(test_size)) * F.col("_cnt")))
    out = _below(hashed, quotas, key_cols, [], "_in")
    return out.withColumn("split", F.when(F.col("_in"), "test").otherwise("train")).drop("_in")


def kfold(df: DataFrame, label_col: str, key_cols: Sequence[str], k: int = 5, seed: int | str = 42) -> DataFrame:
    """Stratified fold number ``(rank within class − 1) mod k`` (an int column usable as
    ``CrossValidator(foldCol=...)``). Rows with a null label are kept, as a class of their own."""
    ranked = hash_rank(df, key_cols, seed, by=[label_col], purpose="fold")
    return ranked.withColumn("fold", ((F.col(RANK) - 1) % k).cast("int")).drop(RANK)
