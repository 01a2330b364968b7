"""Principal components of wide tables by subspace iteration.

A few directions are multiplied by the covariance matrix again and again and made orthonormal in between; they turn into
its leading eigenvectors. The product is one Spark job that adds up ``x (x V - m V)`` over the rows, so the matrix itself
is never formed, and the driver holds a few vectors as long as a row (whose number of columns bounds them), not their
square. Sparse rows cost what they hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.svm import Rows, arrays, blocks_of
from quarry.session import scratch_path, ship_package

MORE = 30                    # directions beyond those asked for, which speed up convergence
WHOLE = 512                  # columns up to which all directions are taken: then one round is exact
ROUNDS = 300
STILL = 1e-12                # change of a direction (1 - cosine) below which it has settled


def _columns(v: np.ndarray) -> np.ndarray:
    """A row of zeros below: rows of :class:`Rows` end with a constant column."""
    return np.vstack([v, np.zeros((1, v.shape[1]))])


def _sum(blocks: DataFrame, width: int, v: np.ndarray | None, shift: np.ndarray | None) -> np.ndarray:
    """Without ``v`` the sum of rows (and their number behind it), else that of ``x (x v - shift)``."""
    held = blocks.sparkSession.sparkContext.broadcast((v, shift))

    def part(batches):
        v, shift = held.value
        total = None
        for b in batches:
            for begin, index, value in zip(*[b.column(x) for x in ("begin", "index", "value")]):
                begin = np.frombuffer(begin.as_buffer(), np.int64)
                r = Rows(begin, np.frombuffer(index.as_buffer(), np.int32), np.frombuffer(value.as_buffer()),
                         np.zeros(len(begin) - 1, np.int32))
                found = r.back(np.ones((len(begin) - 1, 1)) if v is None else r.times(_columns(v)) - shift, width + 1)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"slice": pa.array([0], pa.int32()), "body": pa.array([total.tobytes()], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        found = np.sum([np.frombuffer(x.as_buffer()) for x in t.column("body")], axis=0)
        return pa.table({"slice": t.column("slice").slice(0, 1), "body": pa.array([found.tobytes()], pa.binary())})

    one = blocks.mapInArrow(part, "slice int, body binary").withColumn("slice", (F.spark_partition_id() % 16).cast("int"))
    found = one.groupBy("slice").applyInArrow(add, "slice int, body binary").collect()     # 16 rows at most
    held.destroy()
    return np.sum([np.frombuffer(r["body"]) for r in found], axis=0).reshape(width + 1, -1)


def directions(df: DataFrame, features: str, k: int, seed: int = 42, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """``(mean, components)`` of a vector column: ``k`` orthonormal rows by falling variance, each with its largest
    weight positive. Rows with a null take no part. An empty table gives empty arrays."""
    spark = df.sparkSession
    ship_package(spark)
    rows = df.where(F.col(features).isNotNull())
    width = rows.select(arrays(F.col(features))[2]).agg(F.max("size")).first()[0]
    if not width:
        return np.zeros(0), np.zeros((k, 0))
    path = scratch_path(spark, "pca")
    blocks_of(rows.withColumn("__none", F.lit(0)), features, "__none", path)
    blocks = spark.read.schema("begin binary, index binary, value binary, label binary").parquet(path)
    total = _sum(blocks, width, None, None)[:, 0]
    mean = total[:-1] / total[-1]
    size = width if width <= WHOLE else min(width, k + MORE)
    v = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    for _ in range(rounds):
        z = _sum(blocks, width, v, mean @ v)[:-1]
        small = v.T @ z                          # of the covariance, in these directions
        turn = np.linalg.eigh((small + small.T) / 2)[1][:, ::-1]      # by falling variance
        now = (v @ turn)[:, :k]
        new = np.linalg.qr(z @ turn)[0]
        new *= np.where(np.sum(new * (v @ turn), axis=0) < 0, -1.0, 1.0)
        still = 1 - np.abs(np.sum(new[:, :k] * now, axis=0))
        v = new
        if (still < STILL).all():
            break
    found = v[:, :k].T
    sign = np.sign(found[np.arange(len(found)), np.abs(found).argmax(1)])
    return mean, found * np.where(sign == 0, 1, sign)[:, None]


def project(df: DataFrame, features: str, mean: np.ndarray, components: np.ndarray, out: str = "pca") -> DataFrame:
    """``df`` with ``out``, the centred rows' places along the components (array of double); null for a null vector."""
    held = df.sparkSession.sparkContext.broadcast((components.T, components @ mean))
    index, value, _ = arrays(F.col(features))

    @F.arrow_udf("array<double>")
    def place(index: pa.Array, value: pa.Array) -> pa.Array:
        v, shift = held.value
        n = pa.compute.list_value_length(index).fill_null(0).to_numpy(zero_copy_only=False)
        r = Rows(np.concatenate([[0], np.cumsum(n)]).astype(np.int64), index.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                 value.flatten().to_numpy(zero_copy_only=False), np.zeros(len(index), np.int32))
        return pa.array((r.times(_columns(v)) - shift).tolist(), pa.list_(pa.float64()))

    placed: Column = place(index, value)
    return df.withColumn(out, F.when(F.col(features).isNotNull(), placed))
