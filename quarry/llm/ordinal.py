"""Quality by ordinal cumulative-link regression on graded ratings.

One score for all grades, a weighted sum of hashed text features, and ordered thresholds between the grades:
``P(grade <= k) = sigmoid(threshold_k - score)``. The score's weights are shared by the thresholds, so a rating of any
grade teaches all of them. The fitted model gives every text its expected grade and the probability of a grade at or
above a cut, by which it is selected.

The model is fitted on a bounded sample of the rated rows (``TRAIN_ROWS``, those with the smallest hash of the id);
every document is scored, in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import give_back, tidy
from quarry.llm.features import (DIM, LEAST, STEP, Rows, features, minimise, packed, restrict, sigmoid, telling,
                                 unpack_rows)

TRAIN_ROWS = 10_000
RIDGE = 1.0


@dataclass(frozen=True)
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, rows: Rows) -> np.ndarray:
        """``P(grade >= k)`` for ``k`` = 1, 2, ...; one column for each threshold."""
        return sigmoid(rows.dot(self.weights)[:, None] - self.thresholds[None, :])


def fit(rows: Rows, grade: np.ndarray, grades: int, ridge: float = RIDGE) -> Ordinal:
    """Grades are 0 .. ``grades - 1``. Without rows all grades are alike; a grade that nobody gave gets next to no
    probability."""
    index = telling(rows, grade)
    x = restrict(rows, index)
    row, n, m = x.row_of(), len(index), grades - 1
    share = (np.array([(grade <= k).sum() for k in range(m)]) + 0.5 * (np.arange(m) + 1)) / (len(grade) + 0.5 * grades)
    start = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 1e-3))

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, first, gap = p[:n], p[n], np.exp(np.clip(p[n + 1:], -30, 30))
        theta = first + np.concatenate([[0], np.cumsum(gap)])
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        s = np.bincount(row, weights=x.value * w[x.index], minlength=len(grade))
        low, high = (sigmoid(edges[grade + k] - s) for k in (0, 1))
        prob = np.maximum(high - low, 1e-12)
        value = -np.log(prob).sum() + ridge / 2 * (w @ w)
        ds = 1 - low - high                                      # of the loss by the score
        by_high, by_low = -high * (1 - high) / prob, low * (1 - low) / prob
        dt = np.array([by_high[grade == k].sum() + by_low[grade == k + 1].sum() for k in range(m)])
        dw = np.bincount(x.index, weights=x.value * ds[row], minlength=n) + ridge * w
        tail = np.cumsum(dt[::-1])[::-1]
        return value, np.concatenate([dw, tail[:1], tail[1:] * gap])

    p = minimise(loss, np.concatenate([np.zeros(n), start[:1], gaps])) if m else np.zeros(n)
    w = np.zeros(DIM)
    w[index] = p[:n]
    return Ordinal(w, p[n] + np.concatenate([[0], np.cumsum(np.exp(p[n + 1:]))]) if m else np.zeros(0))


def sample_rated(df: DataFrame, ratings: DataFrame, id: str, text: str, label: str, rows: int) -> DataFrame:
    """``(id, label, x)``: a bounded sample of rows with a label that is not null, with packed features. The sample is
    the same at any time: the smallest hashes of the id."""
    rated = ratings.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label")).where(
        "id is not null and label is not null")
    docs = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    few = rated.join(docs.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id", "label").limit(rows)
    # at most ``rows`` ids and labels
    return docs.join(F.broadcast(few), "id").select("id", "label", packed(F.col("text")).alias("x"))


def rate(df: DataFrame, ratings: DataFrame, grades: int, id: str = "doc_id", text: str = "text",
         grade: str = "grade", cut: int = 1, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``df``: ``id``, ``score``, ``expected_grade``, ``tail`` (probability of a grade of ``cut`` or
    more) and ``selected`` (``tail`` at least one half).

    Ratings without an id or grade are not used, nor those of no document; a document rated twice counts twice. With no
    usable rating every text gets the same probabilities. A null or empty text has no features and gets the
    probabilities of a score of 0. Texts are read whole. An empty table gives an empty result. Other columns are not
    read.
    """
    if not 1 <= cut < grades:
        raise ValueError("cut must be one of the grades above the lowest")
    spark = df.sparkSession
    sample = sample_rated(df, ratings, id, text, grade, train_rows)

    def learn(t: pa.Table) -> pa.Table:
        t = t.sort_by([("id", "ascending"), ("label", "ascending")])
        model = fit(unpack_rows(t.column("x").to_pylist(), LEAST), np.clip(t.column("label").to_numpy(), 0, grades - 1)
                    .astype(np.int64), grades)
        used = np.flatnonzero(model.weights)
        return pa.table({"used": [used.tobytes()], "weights": [model.weights[used].tobytes()],
                         "thresholds": [model.thresholds.tobytes()]})

    # one task fits the bounded sample
    found = sample.groupBy().applyInArrow(tidy(learn), "used binary, weights binary, thresholds binary").collect()
    if found:
        w = np.zeros(DIM)
        w[np.frombuffer(found[0]["used"], np.int64)] = np.frombuffer(found[0]["weights"])
        model = Ordinal(w, np.frombuffer(found[0]["thresholds"]))
    else:
        model = fit(unpack_rows([]), np.zeros(0, np.int64), grades)
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score: double, expected_grade: double, tail: double>")
    def score(texts: pa.Array) -> pa.Array:
        s, e, t = [], [], []
        used = held.value.weights != 0
        for at in range(0, len(texts), STEP):
            x = features(texts.slice(at, STEP), used)
            p = held.value.at_least(x)
            s.append(x.dot(held.value.weights))
            e.append(p.sum(axis=1))
            t.append(p[:, cut - 1])
        give_back()
        join = lambda a: pa.array(np.concatenate(a or [np.zeros(0)]))
        return pa.StructArray.from_arrays([join(s), join(e), join(t)], ["score", "expected_grade", "tail"])

    out = df.select(F.col(f"`{id}`").alias("id"), score(F.col(f"`{text}`")).alias("s")).select("id", "s.*")
    return out.withColumn("selected", F.col("tail") >= 0.5)


