"""K-means for several numbers of clusters in shared scans.

One Lloyd iteration carries every ``k`` at once: a scan assigns each row to its nearest centre of each ``k`` and adds up,
within the task, the rows of every centre; those sums, a few vectors a task, are added over the cluster and give the next
centres. All ``k`` start from beginnings of one sequence of distinct rows, each the farthest from those before it within
a bounded sample. A ``k`` that ends with a larger sum of squares than a smaller one starts again from that one's centres
and the sample row farthest from them, so the curve never rises.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage, ship_package

SAMPLE = 2000                # rows that starts are chosen from: those with the smallest hashes
ROUNDS = 100
STILL = 1e-9                 # relative gain below which a k is done


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _square(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, by differences: exact to the last places also far from the origin."""
    return np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1)


def starts(sample: np.ndarray, k: int) -> np.ndarray:
    """``k`` rows, or as many as differ: the one nearest to the mean, then each time the farthest."""
    first = int(_square(sample, sample.mean(0)[None])[:, 0].argmin())
    chosen, near = [first], _square(sample, sample[first][None])[:, 0]
    while len(chosen) < k and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _square(sample, sample[chosen[-1]][None])[:, 0])
    return sample[chosen]


def scan(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For every ``k`` the rows and the sum of rows of each centre, and the sum of squared distances."""
    spark = points.sparkSession
    held = spark.sparkContext.broadcast(centres)

    def part(batches):
        total = {k: [np.zeros(len(c)), np.zeros(c.shape), 0.0] for k, c in held.value.items()}
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                x = _rows(b.column("x").slice(at, 4096))
                for k, c in held.value.items():
                    d = _square(x, c)
                    of = d.argmin(1)
                    t = total[k]
                    t[0] += np.bincount(of, minlength=len(c))
                    for i in range(len(c)):
                        t[1][i] += x[of == i].sum(0)
                    t[2] += d[np.arange(len(x)), of].sum()
        yield pa.RecordBatch.from_pydict({
            "k": pa.array(list(total), pa.int32()),
            "body": pa.array([np.concatenate([n, s.reshape(-1), [e]]).tobytes() for n, s, e in total.values()], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        found = np.sum([np.frombuffer(x.as_buffer()) for x in t.column("body")], axis=0)
        return pa.table({"k": t.column("k").slice(0, 1), "body": pa.array([found.tobytes()], pa.binary())})

    out = {}
    for r in points.mapInArrow(part, "k int, body binary").groupBy("k").applyInArrow(add, "k int, body binary").collect():
        c, v = centres[r["k"]], np.frombuffer(r["body"])
        out[r["k"]] = v[:len(c)], v[len(c):-1].reshape(c.shape), float(v[-1])
    held.destroy()
    return out


def curve(df: DataFrame, features: str, ks: Sequence[int], rounds: int = ROUNDS, sample: int = SAMPLE) -> dict[int, tuple]:
    """``(sum of squared distances, centres)`` for each ``k``; ``features`` is an array column, rows with a null take no
    part. With fewer distinct rows than ``k`` there are fewer centres. An empty table gives an empty result."""
    ship_package(df.sparkSession)
    points = cut_lineage(df.select(F.col(features).cast("array<double>").alias("x")).where("x is not null"))
    few = points.orderBy(F.xxhash64("x"), "x").limit(sample).select("x").toPandas()["x"]
    if not len(few):
        return {}
    few = np.stack([np.asarray(v, float) for v in few])
    first = starts(few, max(ks))
    centres = {k: first[:k] for k in sorted(set(ks))}
    done: dict[int, tuple] = {}
    last: dict[int, float] = {}
    left = rounds
    while centres and left:
        left -= 1
        for k, (n, s, error) in scan(points, centres).items():
            if k in last and error >= last[k] * (1 - STILL) or error == 0 or not left:
                done[k] = error, centres.pop(k)
                continue
            last[k] = error
            centres[k] = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centres[k])
        if not centres:              # a larger k must not do worse
            for a, b in zip(sorted(done), sorted(done)[1:]):
                if done[b][0] > done[a][0]:
                    c = done[a][1]
                    far = few[_square(few, c).min(1).argmax()]
                    centres[b] = np.vstack([c, far[None]])
                    last.pop(b, None)
                    del done[b]
                    left = max(left, 1)
                    break
    return done
