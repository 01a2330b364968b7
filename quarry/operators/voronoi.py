"""Exact nearest neighbours by pivots: Voronoi cells, rings, and distance bounds.

A few rows of the base serve as pivots. Every base row belongs to the cell of its nearest pivot and, within it, to a
ring of similar distance to that pivot; cell and ring make a block. Small blocks travel together as a shard, a block with
many rows is a shard dealt in parts. Of a block only its number of rows and its smallest and largest distance to the
pivot are kept: a table whose size the parameters bound, whatever the data.

By the triangle inequality a query at distance ``d`` of a pivot is at least ``d - high`` and ``low - d`` from every row
of a block with radii ``low .. high``, at most ``d + high``; and since such a row is nearer to its own pivot than to the
query's, it is at least ``(d^2 - d0^2) / (2 * gap)`` away (``d0``: distance to the query's pivot, ``gap``: between the
two pivots). Queries are answered in two rounds:

1. a query visits the blocks nearest to it that hold ``k`` rows together; its k-th distance there is its reach;
2. it visits every other block whose least possible distance is within its reach, and no more.

Rows of the base are sent once for each batch of queries that meets their shard, queries once for each shard they
visit. No block is ever skipped that could hold a neighbour, so the result is that of comparing all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage, ship_package

BLOCK_ROWS = 2048            # rows of one part of a block, and queries of one batch
CHUNK = 64                   # query rows per numpy step: CHUNK x block x dimensions doubles in memory
DIGITS = 9                   # distances are rounded before ordering, so ties break the same way in every engine
PIVOTS = 1024                # at most
RINGS = 8                    # of a cell
SLACK = 1e-6                 # added to a reach; far more than what rounding can hide


def matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.to_numpy()])


def distances(q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All Euclidean distances, exact to the last places (no expansion of the square)."""
    out = np.empty((len(q), len(b)))
    for s in range(0, len(q), CHUNK):
        diff = q[s:s + CHUNK, None, :] - b[None, :, :]
        out[s:s + CHUNK] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def near_first(d: np.ndarray, keys: np.ndarray, take: int) -> np.ndarray:
    """For each row of distances the ``take`` nearest columns, ties by key: only columns up to the ``take``-th
    smallest distance are ordered."""
    if take >= d.shape[1]:
        return np.stack([np.lexsort((keys, row)) for row in d])
    edge = np.partition(d, take - 1, axis=1)[:, take - 1]
    out = np.empty((len(d), take), np.int64)
    for i, row in enumerate(d):
        near = np.flatnonzero(row <= edge[i])
        out[i] = near[np.lexsort((keys[near], row[near]))[:take]]
    return out


class Blocks:
    """What is known of the base's blocks, for bounds."""

    def __init__(self, pivots: np.ndarray, cell: np.ndarray, ring: np.ndarray, n: np.ndarray, low: np.ndarray,
                 high: np.ndarray, rows: int):
        self.pivots, self.cell, self.ring, self.n, self.low, self.high = pivots, cell, ring, n, low, high
        self.shard, self.parts = _shards(n, rows)
        self.gap = distances(pivots, pivots)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible distance of every query to the rows of every block."""
        d = distances(q, self.pivots)
        own = d.argmin(1)
        d0 = d[np.arange(len(q)), own][:, None]
        gap = self.gap[own]
        beyond = np.where(gap > 0, (d ** 2 - d0 ** 2) / np.where(gap > 0, 2 * gap, 1.0), 0.0)[:, self.cell]
        d = d[:, self.cell]
        least = np.maximum(np.maximum(d - self.high, self.low - d), np.maximum(beyond, 0.0))
        return least, d + self.high

    def first(self, least: np.ndarray, most: np.ndarray, k: int) -> np.ndarray:
        """The blocks of the first round, as marks: those of smallest middle distance that hold ``k`` rows together."""
        order = np.argsort(least + most, axis=1, kind="stable")
        before = np.cumsum(self.n[order], axis=1) - self.n[order]
        out = np.zeros(least.shape, bool)
        np.put_along_axis(out, order, before < k, axis=1)
        return out


def _pivots(base: DataFrame, n: int, limit: int) -> np.ndarray:
    """Base rows with the smallest hashes; of equal rows one."""
    count = int(min(limit, max(1, math.isqrt(n))))
    rows = base.orderBy(F.xxhash64("bk"), "bk").limit(count).select("bv").toPandas()
    return np.unique(matrix(rows["bv"]), axis=0) if len(rows) else np.zeros((0, 0))


def _visits(queries: DataFrame, blocks, k: int, round_: int) -> DataFrame:
    """``qk, shard, part, wanted``: one row for each part of a shard that a query visits, with the blocks it wants."""

    def run(frames):
        b = blocks.value
        edge = np.flatnonzero(np.append(True, b.shard[1:] != b.shard[:-1]))
        for pdf in frames:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at:at + 256]
                least, most = b.bounds(matrix(part["qv"]))
                first = b.first(least, most, k)
                visit = first if round_ == 1 else ~first & (least <= part["reach"].to_numpy()[:, None] + SLACK)
                q, block = np.nonzero(visit)
                shard = b.shard[block]
                cut = np.flatnonzero(np.append(True, (q[1:] != q[:-1]) | (shard[1:] != shard[:-1]))) if len(q) else q
                yield pd.DataFrame({"qk": part["qk"].to_numpy()[q[cut]], "shard": shard[cut],
                                    "parts": b.parts[edge][shard[cut]],
                                    "wanted": np.split(block.astype(np.int32), cut[1:]) if len(cut) else []})

    named = queries.mapInPandas(run, "qk long, shard int, parts int, wanted array<int>")
    return named.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def _shards(n: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks put together in their order to shards of about ``rows`` rows, and the parts of each block's shard."""
    shard, parts, held = np.zeros(len(n), np.int64), np.ones(len(n), np.int64), 0
    for i, x in enumerate(n.tolist()):
        if i:
            new = held + x > rows
            shard[i] = shard[i - 1] + new
            held = 0 if new else held
        held += x
        parts[i] = -(-x // rows)
    return shard, parts


def _kernel(k: int):
    """For one batch of queries and one part of a shard: the ``k`` nearest of the blocks that each query wants."""

    def run(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if lp.empty or rp.empty:
            return pd.DataFrame({"qk": [], "bk": [], "lab": [], "dist": []})
        rp = rp.sort_values("block", kind="stable")
        qm, bm = matrix(lp["qv"]), matrix(rp["bv"])
        keys, labs, qkeys, block = rp["bk"].to_numpy(), rp["lab"].to_numpy(), lp["qk"].to_numpy(), rp["block"].to_numpy()
        wanted = np.concatenate(lp["wanted"].to_numpy())
        row = np.repeat(np.arange(len(lp)), lp["wanted"].map(len).to_numpy())
        out = []
        for i in np.unique(wanted):
            lo, hi = np.searchsorted(block, [i, i + 1])
            rows = row[wanted == i]
            take = min(k, hi - lo)
            for s in range(0, len(rows) if take else 0, CHUNK):
                q = rows[s:s + CHUNK]
                d = np.round(distances(qm[q], bm[lo:hi]), DIGITS)
                order = near_first(d, keys[lo:hi], take)
                out.append(pd.DataFrame({"qk": np.repeat(qkeys[q], take), "bk": keys[lo:hi][order].ravel(),
                                         "lab": labs[lo:hi][order].ravel(),
                                         "dist": np.take_along_axis(d, order, 1).ravel()}))
        if not out:
            return pd.DataFrame({"qk": [], "bk": [], "lab": [], "dist": []})
        found = pd.concat(out).sort_values(["qk", "dist", "bk"])
        return found.groupby("qk", sort=False).head(k)

    return run


def nearest(query: DataFrame, base: DataFrame, k: int, block_rows: int = BLOCK_ROWS, pivots: int = PIVOTS,
            rings: int = RINGS) -> tuple[DataFrame, DataFrame]:
    """The ``k`` nearest rows of ``base`` (``bk long, bv array<double>, lab long``) for every row of ``query``
    (``qk long, qv array<double>``): ``(qk, bk, lab, dist, rank)``, ties by ``bk``; and one row of what was compared:
    ``compared`` and ``pairs`` (of all). Keys are unique on each side; vectors have no nulls and one length."""
    spark = query.sparkSession
    ship_package(spark)
    query, base = cut_lineage(query), cut_lineage(base)
    n_base, n_query = base.count(), query.count()
    nothing = spark.createDataFrame([], "qk long, bk long, lab long, dist double, rank int")
    if not n_base or not n_query:
        return nothing, spark.createDataFrame([(0, 0)], "compared long, pairs long")
    w = Window.partitionBy("qk").orderBy("dist", "bk")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    if n_base <= block_rows:         # one shard: nothing to bound
        batches = max(-(-n_query // block_rows), spark.sparkContext.defaultParallelism)
        left = query.withColumn("batch", F.pmod(F.xxhash64("qk"), F.lit(batches)).cast("int")).withColumn(
            "wanted", F.array(F.lit(0)))
        right = base.withColumn("block", F.lit(0)).withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
        found = left.groupBy("batch").cogroup(right.groupBy("batch")).applyInPandas(
            _kernel(k), "qk long, bk long, lab long, dist double")
        return best(found), spark.createDataFrame([(n_base * n_query,) * 2], "compared long, pairs long")

    held = spark.sparkContext.broadcast(_pivots(base, n_base, pivots))

    def place(frames):
        p = held.value
        for pdf in frames:
            for at in range(0, len(pdf), 2048):
                part = pdf.iloc[at:at + 2048]
                d = distances(matrix(part["bv"]), p)
                cell = d.argmin(1)
                yield part.assign(cell=cell.astype(np.int32), radius=d[np.arange(len(d)), cell])

    placed = cut_lineage(base.mapInPandas(place, "bk long, bv array<double>, lab long, cell int, radius double"))
    widest = placed.groupBy("cell").agg(F.min("radius").alias("inner"), F.max("radius").alias("outer"))
    ringed = placed.join(widest, "cell").withColumn("ring", F.when(
        F.col("outer") > F.col("inner"), F.least(F.lit(rings - 1), F.floor(
            (F.col("radius") - F.col("inner")) / (F.col("outer") - F.col("inner")) * rings))).otherwise(0).cast("int"))
    ringed = ringed.select("bk", "bv", "lab", "cell", "ring", "radius")
    # at most pivots x rings rows
    stats = ringed.groupBy("cell", "ring").agg(F.count("*").alias("n"), F.min("radius").alias("low"),
                                               F.max("radius").alias("high")).orderBy("cell", "ring").toPandas()
    known = Blocks(held.value, *[stats[c].to_numpy() for c in ("cell", "ring", "n", "low", "high")], block_rows)
    blocks = spark.sparkContext.broadcast(known)
    number = spark.createDataFrame([(int(c), int(r), i, int(h), int(p)) for i, (c, r, h, p) in enumerate(
        zip(known.cell, known.ring, known.shard, known.parts))], "cell int, ring int, block int, shard int, parts int")
    dealt = cut_lineage(ringed.join(number, ["cell", "ring"]).select(
        "bk", "bv", "lab", "block", "shard", F.pmod(F.xxhash64("bk", F.lit(1)), F.col("parts")).cast("int").alias("part")))

    def compare(queries: DataFrame, round_: int) -> tuple[DataFrame, DataFrame]:
        visits = cut_lineage(_visits(queries, blocks, k, round_))
        # a shard that many queries visit meets them in batches
        place = ["shard", "part"]
        load = visits.groupBy(*place).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("batches"))
        load = cut_lineage(load)
        left = (visits.join(load, place)
                .withColumn("batch", F.pmod(F.xxhash64("qk", F.lit(2)), F.col("batches")).cast("int"))
                .select("qk", "wanted", *place, "batch").join(query, "qk"))
        right = (dealt.join(load, place).withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)))
                 .select("bk", "bv", "lab", "block", *place, "batch"))
        keys = [*place, "batch"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            _kernel(k), "qk long, bk long, lab long, dist double")
        sizes = dealt.groupBy("block", "part").agg(F.count("*").alias("rows"))
        work = (visits.select(F.explode("wanted").alias("block"), "part").groupBy("block", "part")
                .agg(F.count("*").alias("visits")).join(sizes, ["block", "part"])
                .agg(F.sum(F.col("visits") * F.col("rows")).alias("compared")))
        return cut_lineage(best(found)), work

    near, work1 = compare(query, 1)
    reach = near.groupBy("qk").agg(F.max(F.when(F.col("rank") == k, F.col("dist"))).alias("reach"))
    second = query.join(reach, "qk").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
    far, work2 = compare(second.select("qk", "qv", "reach"), 2)
    both = best(near.drop("rank").union(far.drop("rank")))
    work = work1.union(work2).agg(F.coalesce(F.sum("compared"), F.lit(0)).cast("long").alias("compared"),
                                  F.lit(n_base * n_query).cast("long").alias("pairs"))
    return both.select("qk", "bk", "lab", "dist", "rank"), work
