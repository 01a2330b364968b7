"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Shards are cut into cells, the slot ranges that one task orders. The rows of each source partition go to cells in
numbers that are drawn exactly as a uniform shuffle of all rows would give them: row i of the communication matrix is
multivariate hypergeometric given the rows before it. Each partition then deals a random permutation of its quota to
its rows (local permutation), the rows move to their cells (exchange), and every cell orders what it got by random
keys (second permutation). Shard and cell sizes are fixed beforehand, so no rebalancing follows.

No task or driver holds the matrix. The cell totals are split down a binary tree over the source partitions, each node
with a generator seeded by the node, so a task draws its own row in O(cells * log partitions) from the partition sizes
alone. The input is first written to the shared folder: a source partition is a written file, and a row is known by
its file and its place there, whatever executors are lost and however the file is later split into tasks.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path

SEED = 20240731
ROWS_A_CELL = 5_000          # while that makes at most MAX_CELLS cells; cells grow with the input after that
MAX_CELLS = 1 << 16
_NUMPY_MAX = 10**9           # numpy's hypergeometric takes populations below this


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many good ones are among ``draws`` drawn without replacement. Exact for any size: beyond numpy's limit
    each side is thinned by coin flips, which leaves a uniform subset of a random size near ``draws``; the few too
    many or too few are then drawn in the same way from what was, or was not, taken."""
    if good == 0 or draws == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < _NUMPY_MAX:
        return int(rng.hypergeometric(good, bad, draws))
    p = draws / (good + bad)
    g, b = int(rng.binomial(good, p)), int(rng.binomial(bad, p))
    over = g + b - draws
    if over > 0:
        return g - hypergeometric(rng, g, b, over)
    if over < 0:
        return g + hypergeometric(rng, good - g, bad - b, -over)
    return g


def split_counts(rng: np.random.Generator, totals: np.ndarray, draws: int) -> np.ndarray:
    """Multivariate hypergeometric: how many of each kind are among ``draws``."""
    out = np.zeros_like(totals)
    rest = int(totals.sum())
    for k in np.flatnonzero(totals):
        if draws == 0:
            break
        n = int(totals[k])
        out[k] = hypergeometric(rng, n, rest - n, draws)
        rest -= n
        draws -= int(out[k])
    return out


def matrix_row(sizes: np.ndarray, totals: np.ndarray, i: int, seed: int) -> np.ndarray:
    """Row ``i`` of the matrix whose rows add up to ``sizes`` and whose columns add up to ``totals``."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    lo, hi = 0, len(sizes)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = split_counts(rng, totals, int(ends[mid] - ends[lo]))
        if i < mid:
            totals, hi = left, mid
        else:
            totals, lo = totals - left, mid
    return totals


def cell_sizes(rows: int, shards: int, rows_a_cell: int) -> tuple[np.ndarray, int]:
    """Size of every cell (cells of shard 0 first) and cells per shard. Shard sizes differ by at most one, and so do
    the cells of a shard."""
    per = max(1, min(-(-rows // (shards * rows_a_cell)), MAX_CELLS // shards))
    shard = np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)
    cells = shard[:, None] // per + (np.arange(per)[None, :] < (shard % per)[:, None])
    return cells.reshape(-1), per


def shuffle_to_shards(df: DataFrame, shards: int = 16, seed: int = SEED, rows_a_cell: int = ROWS_A_CELL) -> DataFrame:
    """All rows of ``df`` with two more columns: ``shard`` (int) and ``slot`` (long, gapless from 0 within the
    shard). Every assignment of rows to slots is equally likely; shard sizes differ by at most one. The rows of a
    cell come out together and in slot order.

    Rows are dealt by their place, not by what they hold: nulls in any column, empty and very long texts and
    repeated rows are rows like any other. An empty table gives an empty result; with fewer rows than shards some
    shards stay empty. Columns of the input named like the two new ones are replaced by them, in any case of letters;
    all others are kept.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = df.sparkSession
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    names = [f"c{i}" for i in range(len(kept))]
    path = scratch_path(spark, "shards")
    (df.select([df[f"`{c}`"].alias(n) for c, n in zip(kept, names)])
       .withColumns({n: F.col(n).cast("string") for c, n in zip(kept, names) if df.schema[c].dataType == T.NullType()})
       .write.option("compression", "zstd").parquet(path))
    file = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    staged = spark.read.schema(_schema(df, kept, names)).parquet(path).withColumns(
        {"file": file, "row": F.col("_metadata.row_index")})
    found = sorted((r["file"], r["count"]) for r in staged.groupBy("file").count().collect())
    files = np.array([f for f, _ in found], np.int64)
    sizes = np.array([n for _, n in found], np.int64)
    total = int(sizes.sum())
    cells, per = cell_sizes(total, shards, rows_a_cell)

    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def plan(number: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell and second random key of every row of a file, by place; a task keeps those of one file."""
        if number not in held:
            i = int(np.searchsorted(files, number))
            rng = np.random.default_rng([seed, number])
            quota = matrix_row(sizes, cells, i, seed)
            held.clear()
            held[number] = (rng.permutation(np.repeat(np.arange(len(cells)), quota)),
                            rng.integers(0, 1 << 62, int(sizes[i])))
        return held[number]

    @F.arrow_udf("struct<cell: long, key: long>")
    def deal(number: pa.Array, row: pa.Array) -> pa.Array:
        number, row = np.asarray(number), np.asarray(row)
        cell, key = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
        for f in np.unique(number):
            here = number == f
            to, keys = plan(int(f))
            cell[here], key[here] = to[row[here]], keys[row[here]]
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(key)], ["cell", "key"])

    # one exchange; ordering a cell is an external sort
    within = Window.partitionBy("at.cell").orderBy("at.key", "file", "row")
    size, extra = F.col("shard_rows") / F.lit(per), F.col("shard_rows") % F.lit(per)
    dealt = (staged.withColumn("at", deal("file", "row"))
             .withColumn("rank", F.row_number().over(within).cast("long") - 1)
             .withColumn("shard", F.floor(F.col("at.cell") / F.lit(per)).cast("int"))
             .withColumn("number", F.col("at.cell") % F.lit(per))
             .withColumn("shard_rows", F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)))
    slot = F.col("number") * F.floor(size) + F.least("number", extra) + F.col("rank")
    return dealt.select(*[F.col(n).alias(c) for c, n in zip(kept, names)], "shard", slot.cast("long").alias("slot"))


def _schema(df: DataFrame, kept: list[str], names: list[str]) -> T.StructType:
    kind = {f.name: f.dataType for f in df.schema}
    return T.StructType([T.StructField(n, T.StringType() if kind[c] == T.NullType() else kind[c])
                         for c, n in zip(kept, names)])


