"""Exact nearest neighbours and exact silhouette.

Nearest neighbours go by pivots and distance bounds (:mod:`quarry.operators.voronoi`). The exact Euclidean silhouette
needs every distance. Rows are dealt to blocks by cluster: a block holds whole clusters, or a part of one that is larger
than a block. Two blocks meet once, in ``cogroup().applyInPandas``, and each distance serves both its rows. A row takes
from the other block one sum, or the least mean of the whole clusters there, so neither pairs nor means are ever rows:
what is sent is a few numbers for each row and block. Memory per task is bounded by the rows and values of a block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import voronoi
from quarry.operators.voronoi import BLOCK_ROWS, matrix
from quarry.session import cut_lineage, ship_package

PAIR_ROWS = 32_768           # rows of a silhouette block, at most
PAIR_VALUES = 1 << 21        # and components of their vectors together
LEAST_ROWS = 1024            # of a block, where cores would allow smaller ones
ROWS, COLS = 256, 512        # of one product: its distances stay in a core's cache
NEAR = 1e-2                  # closer pairs, as a share of both squared lengths, are taken from their difference
NEAR_PAIRS = 4096            # of these at once


def knn_candidates(query: DataFrame, base: DataFrame, query_key: str, base_key: str, features: str,
                   label: str, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_key, neighbour, label, dist, rank)``: the exact k nearest base rows of every query row
    (``neighbour`` = their ``base_key``), distance ties broken by base key. Pivots and distance bounds decide what is
    compared (:mod:`quarry.operators.voronoi`); rows without features take no part."""
    q = query.select(F.col(query_key).alias("qk"), F.col(features).alias("qv")).where("qv is not null")
    b = base.select(F.col(base_key).alias("bk"), F.col(features).alias("bv"),
                    F.col(label).cast("long").alias("lab")).where("bv is not null")
    best, _ = voronoi.nearest(q, b, k, block_rows)
    return best.select(F.col("qk").alias(query_key), F.col("bk").alias("neighbour"), F.col("lab").alias(label),
                       "dist", "rank")


def knn_predict(query: DataFrame, base: DataFrame, key: str, features: str, label: str, k: int = 5,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Majority label of the k nearest base rows; a tie goes to the smallest label.
    Returns ``(key, prediction)``."""
    nn = knn_candidates(query, base, key, key, features, label, k, block_rows)
    votes = nn.groupBy(F.col(key).alias("_q"), label).agg(F.count(F.lit(1)).alias("_votes"))
    w = Window.partitionBy("_q").orderBy(F.col("_votes").desc(), label)
    return (votes.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select(F.col("_q").alias(key), F.col(label).cast("int").alias("prediction")))


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _tiles(q: np.ndarray, b: np.ndarray):
    """Distances of the rows ``q`` to all rows ``b``, some columns at a time: ``(first column, distances)``. They come
    from ``|x|^2 - 2xy + |y|^2`` around the mean of ``q``, as one matrix product. Where that loses digits (a pair is close
    for its lengths, or not finite) the difference itself is squared."""
    centre = q.mean(0)
    x, y = q - centre, b - centre
    nx, ny = _squares(x), _squares(y)
    x = np.column_stack([-2 * x, nx, np.ones(len(x))])
    y = np.column_stack([y, np.ones(len(y)), ny])
    for at in range(0, len(b), COLS):
        d, n = x @ y[at:at + COLS].T, ny[at:at + COLS]
        if not d.min() >= NEAR * (nx.max() + n.max()):       # NaN is not >= anything
            i, j = np.nonzero(~(d >= NEAR * (nx[:, None] + n)))
            for s in range(0, len(i), NEAR_PAIRS):
                near = i[s:s + NEAR_PAIRS], j[s:s + NEAR_PAIRS]
                d[near] = _squares(q[near[0]] - b[at + near[1]])
        yield at, np.sqrt(d, out=d)


class _Side:
    """The rows of one block, in order of cluster, and what they take from the clusters of the other block."""

    def __init__(self, pdf: pd.DataFrame, code: np.ndarray):
        order = np.argsort(code, kind="stable")
        self.key, self.c = pdf["qk"].to_numpy()[order], pdf["c"].to_numpy()[order]
        self.code, self.x, self.cut = code[order], matrix(pdf["v"])[order], bool(pdf["cut"].iat[0])
        self.names, self.segment, self.n = np.unique(self.code, return_inverse=True, return_counts=True)
        self.sum, self.least = np.zeros(len(pdf)), np.full(len(pdf), np.nan)

    def take(self, rows: slice, sums: np.ndarray, names: np.ndarray, n: np.ndarray, cut: bool) -> None:
        """``sums``: of the distances of some rows to each of some clusters ``names`` of ``n`` rows."""
        if cut:
            self.sum[rows] = sums[:, 0]
            return
        own = self.code[rows][:, None] == names
        self.sum[rows] += np.where(own, sums, 0.0).sum(1)
        self.least[rows] = np.fmin(self.least[rows], np.fmin.reduce(np.where(own, np.nan, sums / n), axis=1))

    def taken(self, other: _Side) -> pd.DataFrame:
        """Of a cut cluster the sum goes to that cluster, else it is that of the row's own cluster (0 if not there)."""
        if other.cut:
            c, n = np.repeat(other.c[:1], len(self.key)), np.full(len(self.key), len(other.key))
        else:
            at = np.minimum(np.searchsorted(other.names, self.code), len(other.names) - 1)
            c, n = self.c, np.where(other.names[at] == self.code, other.n[at], 0)
        return pd.DataFrame({"qk": self.key, "own": self.c, "c": c, "sum_d": self.sum, "cnt": n, "least": self.least})


def _compare(left: _Side, right: _Side, both: bool) -> None:
    """Every row of ``left`` takes from ``right``; if ``both``, by the same distances every row of ``right`` from
    ``left``: a cluster's sums are complete when the next cluster begins."""
    held = None

    def give() -> None:
        right.take(slice(None), held[1][:, None], left.names[held[0]:held[0] + 1], left.n[held[0]:held[0] + 1], left.cut)

    for s in range(0, len(left.x), ROWS):
        rows, part = slice(s, s + ROWS), left.segment[s:s + ROWS]
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sums = np.zeros((len(part), len(right.names)))
        down = np.empty((len(starts), len(right.x))) if both else None
        for at, d in _tiles(left.x[rows], right.x):
            segment = right.segment[at:at + COLS]
            first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            sums[:, segment[first]] += np.add.reduceat(d, first, axis=1)
            if both:
                down[:, at:at + COLS] = d.sum(0) if len(starts) == 1 else np.add.reduceat(d, starts, axis=0)
        left.take(rows, sums, right.names, right.n, right.cut)
        for i, more in zip(part[starts], down if both else ()):
            if held is not None and held[0] == i:
                held[1] += more
                continue
            if held is not None:
                give()
            held = [i, more.copy()]
    if held is not None:
        give()


def _meet(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
    """Kernel of two blocks that meet, or of a block with itself."""
    if lp.empty or rp.empty:
        return pd.DataFrame({c: [] for c in ("qk", "own", "c", "sum_d", "cnt", "least")})
    both = lp["i"].iat[0] != lp["j"].iat[0]
    _, code = np.unique(np.concatenate([lp["c"].to_numpy(), rp["c"].to_numpy()]), return_inverse=True)
    left, right = _Side(lp, code[:len(lp)]), _Side(rp, code[len(lp):])
    with np.errstate(all="ignore"):
        _compare(left, right, both)
    return pd.concat([left.taken(right), right.taken(left)]) if both else left.taken(right)


def _dealt(p: DataFrame, n: int, rows: int) -> tuple[DataFrame, int]:
    """``p`` with its ``block`` of about ``rows`` rows and whether that is ``cut`` out of one cluster; number of blocks.
    Clusters over an eighth of a block (there are at most 8 for each block) are placed one by one, others by hash."""
    large = (p.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows // 8)
             .orderBy(F.col("n").desc(), "c").collect())
    placed, free, blocks = [], [], 0
    for r in large:
        parts, at = -(-r["n"] // rows), blocks
        if parts == 1:
            fits = [i for i, room in enumerate(free) if room[1] >= r["n"]]
            if fits:
                at = free[fits[0]][0]
                free[fits[0]][1] -= r["n"]
            else:
                free.append([at, rows - r["n"]])
        blocks = max(blocks, at + parts)
        placed.append((r["c"], at, parts))
    hashed = -(-(n - sum(r["n"] for r in large)) // rows)
    where = p.sparkSession.createDataFrame(placed, f"c {p.schema['c'].dataType.simpleString()}, at int, parts int")
    block = F.when(F.col("at").isNull(), blocks + F.pmod(F.xxhash64("c"), F.lit(max(hashed, 1)))).otherwise(
        F.col("at") + F.pmod(F.xxhash64("qk"), F.col("parts")))
    return p.join(F.broadcast(where), "c", "left").select(
        "qk", "v", "c", block.cast("int").alias("block"), F.coalesce(F.col("parts") > 1, F.lit(False)).alias("cut")
    ), blocks + hashed


def silhouette(points: DataFrame, key: str, features: str, cluster: str, block_rows: int = PAIR_ROWS) -> DataFrame:
    """V6: exact Euclidean silhouette ``mean((b - a) / max(a, b))``; single-member clusters score 0, as do rows at no
    distance from both clusters and rows without a cluster (which take no part in others' scores); rows without features
    are left out. Returns per-point ``(key, cluster, a, b, s)``; average ``s`` for the score."""
    spark = points.sparkSession
    ship_package(spark)
    whole = cut_lineage(points.select(F.col(key).alias("qk"), F.col(features).cast("array<double>").alias("v"),
                                      F.col(cluster).alias("c")).where("v is not null"))
    p = whole.where("c is not null")
    n, size = p.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    # every core gets several pairs of blocks
    cores = spark.sparkContext.defaultParallelism
    rows = min(block_rows, max(1, PAIR_VALUES // max(size or 1, 1)), max(LEAST_ROWS, math.ceil(n / math.sqrt(16 * cores))))
    dealt, blocks = _dealt(p, n, rows)
    pairs = max(1, blocks * (blocks + 1) // 2)
    parts = min(2 * pairs, 32 * cores + n * (blocks + 1) * (size or 1) // PAIR_VALUES, 10_000)

    def side(mine: str, other: str, low, high) -> DataFrame:
        out = dealt.withColumn(other, F.explode(F.sequence(low, high))).withColumnRenamed("block", mine)
        out = out.toDF(*out.columns)         # columns of its own, or the two sides could not be told apart
        return out.repartition(parts, "i", "j")

    left = side("i", "j", F.col("block"), F.lit(max(blocks - 1, 0)))
    right = side("j", "i", F.lit(0), F.col("block"))
    key_type, type_ = (p.schema[c].dataType.simpleString() for c in ("qk", "c"))
    sums = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(
        _meet, f"qk {key_type}, own {type_}, c {type_}, sum_d double, cnt long, least double")
    per = sums.groupBy("qk", "own", "c").agg(
        F.sum("sum_d").alias("sum_d"), F.sum("cnt").alias("cnt"), F.min("least").alias("least"))
    mine = F.col("c") == F.col("own")
    agg = per.groupBy("qk", "own").agg(
        F.max(F.when(mine, F.try_divide("sum_d", F.col("cnt") - 1))).alias("a"),
        F.max(F.when(mine, F.col("cnt"))).alias("own_n"),
        F.least(F.min("least"), F.min(F.when(~mine, F.col("sum_d") / F.col("cnt")))).alias("b"))
    s = (F.when((F.col("own_n") <= 1) | F.col("b").isNull() | (F.greatest("a", "b") == 0), F.lit(0.0))
         .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b")))
    scored = agg.select("qk", "own", "a", "b", F.coalesce(s, F.lit(0.0)).alias("s"))
    nothing = F.lit(None).cast("double")
    alone = whole.where("c is null").select("qk", F.col("c").alias("own"), nothing, nothing, F.lit(0.0))
    return scored.union(alone).select(F.col("qk").alias(key), F.col("own").alias(cluster), "a", "b", "s")


def _to_clusters(held):
    """From a vector and its cluster, by the clusters' sums in ``held``: the mean squared distance to the others of its
    own cluster and its size, if that is among them, and the least to another cluster."""

    @F.pandas_udf("own double, n long, other double")
    def near(v: pd.Series, c: pd.Series) -> pd.DataFrame:
        names, n, q, s = held.value
        x = matrix(v)
        total = np.maximum(n * (x * x).sum(1)[:, None] - 2 * x @ s.T + q, 0.0)
        mine = c.to_numpy()[:, None] == names
        own = mine.any(1)
        mean = np.where(mine, np.inf, total / n).min(1)
        count = np.where(own, n[mine.argmax(1)], 0)
        return pd.DataFrame({
            "own": np.where(own & (count > 1), total[np.arange(len(x)), mine.argmax(1)] / np.maximum(count - 1, 1), np.nan),
            "n": count.astype(np.int64), "other": np.where(np.isinf(mean), np.nan, mean)})

    return near


def silhouette_squared(points: DataFrame, key: str, features: str, cluster: str, block: int = 1024) -> DataFrame:
    """V6 by squared Euclidean distance, in one linear pass: ``(key, cluster, a, b, s)`` as :func:`silhouette`, with
    mean squared distances. The number of rows, the sum of rows and the sum of squared lengths of a cluster give a
    point's mean squared distance to it, so points are never compared with each other. The clusters' sums are held
    ``block`` clusters at a time; rows with a null cluster or null features take no part."""
    spark = points.sparkSession
    ship_package(spark)
    p = points.select(F.col(key).alias("k"), F.col(features).cast("array<double>").alias("v"),
                      F.col(cluster).alias("c")).where("v is not null and c is not null")
    n = p.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    sums = (p.select("c", F.posexplode("v").alias("i", "x")).groupBy("c", "i").agg(
        F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
        .groupBy("c").agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s"), F.sum("q").alias("q")))
    known = sums.join(n, "c").select("c", "n", "q", F.col("s.s").alias("s")).orderBy("c").toPandas()
    out = p.withColumn("own", F.lit(None).cast("struct<a:double,n:long>")).withColumn("b", F.lit(None).cast("double"))
    for at in range(0, len(known), block):
        part = known.iloc[at:at + block]
        held = spark.sparkContext.broadcast((part["c"].to_numpy(), part["n"].to_numpy(float), part["q"].to_numpy(float),
                                             np.stack([np.asarray(s, float) for s in part["s"]])))
        out = out.withColumn("m", _to_clusters(held)("v", "c")).select(
            "k", "v", "c", F.when(F.col("m.n") > 0, F.struct(F.nanvl("m.own", F.lit(None)).alias("a"), F.col("m.n").alias("n")))
            .otherwise(F.col("own")).alias("own"), F.least(F.nanvl("m.other", F.lit(None)), "b").alias("b"))
    a, b = F.col("own.a"), F.col("b")
    s = F.when((F.col("own.n") <= 1) | b.isNull() | (F.greatest(a, b) == 0), 0.0).otherwise((b - a) / F.greatest(a, b))
    return out.select(F.col("k").alias(key), F.col("c").alias(cluster), a.alias("a"), "b", s.alias("s"))
