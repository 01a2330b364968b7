"""Toxicity by a classifier chain.

Categories are predicted one after the other. The linear model of a category reads the hashed features of the text and
the probabilities of all categories before it. When a category is trained, those probabilities are out of fold: each
training row's comes from a model that never saw the row, so later models learn from predictions as good, or as bad, as
they will meet. Scoring runs the final models in the order of the chain, in one pass without a shuffle.

The chain is fitted on a bounded sample of the labelled rows (``TRAIN_ROWS``, those with the smallest hash of the id);
folds and final model of a category are fitted side by side, one task each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut_lineage, give_back, tidy
from quarry.llm.features import (DIM, LEAST, STEP, Rows, features, minimise, packed, restrict, sigmoid, telling,
                                 unpack_rows)

TRAIN_ROWS = 10_000
FOLDS = 3
RIDGE = 0.1


def with_columns(rows: Rows, extra: np.ndarray) -> Rows:
    """``rows`` with dense columns appended after the last feature."""
    k = extra.shape[1]
    if not k:
        return rows
    n = np.diff(rows.begin)
    begin = np.concatenate([[0], np.cumsum(n + k)])
    index, value = np.empty(begin[-1], rows.index.dtype), np.empty(begin[-1], rows.value.dtype)
    old = np.arange(len(rows.index)) + np.repeat(np.arange(len(rows)) * k, n)
    index[old], value[old] = rows.index, rows.value
    new = (begin[1:, None] - k + np.arange(k)[None, :]).reshape(-1)
    index[new], value[new] = np.tile(DIM + np.arange(k), len(rows)), extra.reshape(-1)
    return Rows(begin, index, value)


def fit_link(rows: Rows, label: np.ndarray, earlier: int, ridge: float = RIDGE) -> np.ndarray:
    """Logistic regression; the weights end with those of the ``earlier`` probabilities and the intercept."""
    index = worth(rows, label, earlier)
    w = np.zeros(DIM + earlier + 1)
    p = fit_few(restrict(rows, index), len(index), label, ridge)
    w[index], w[-1] = p[:-1], p[-1]
    return w


def worth(rows: Rows, label: np.ndarray, earlier: int) -> np.ndarray:
    """Indices that get a weight."""
    return np.union1d(telling(rows, label), DIM + np.arange(earlier))


def fit_few(x: Rows, n: int, label: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the ``n`` features of ``x``, then the intercept."""
    row = x.row_of()
    base = (label.sum() + 0.5) / (len(label) + 1)

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        s = np.bincount(row, weights=x.value * p[x.index], minlength=len(label)) + p[n]
        q = sigmoid(s)
        value = np.logaddexp(0, np.where(label, -s, s)).sum() + ridge / 2 * (p[:n] @ p[:n])
        d = q - label
        return value, np.append(np.bincount(x.index, weights=x.value * d[row], minlength=n) + ridge * p[:n], d.sum())

    return minimise(loss, np.append(np.zeros(n), np.log(base / (1 - base))))


def predict(rows: Rows, w: np.ndarray) -> np.ndarray:
    return sigmoid(rows.dot(w[:-1]) + w[-1])


def train_chain(sample: DataFrame, categories: list[str], folds: int = FOLDS) -> list[np.ndarray]:
    """Weights of every category's final model. ``sample``: ``id``, ``x`` (packed features) and ``label``, an array of
    a boolean for each category in order; its size is bounded by the caller."""
    current = sample.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(folds))).withColumn(
        "seen", F.array().cast("array<double>"))
    chain: list[np.ndarray] = []
    for k in range(len(categories)):
        def learn(t: pa.Table) -> pa.Table:
            part = t.column("part")[0].as_py()
            order = np.argsort(t.column("row").to_numpy(), kind="stable")
            extra = np.array(t.column("seen").to_pylist(), float).reshape(t.num_rows, k)[order]
            number, fold = t.column("row").to_numpy()[order], t.column("fold").to_numpy()[order]
            label = np.array([bool(y[k]) for y in t.column("label").to_pylist()])[order]
            raw = [x.as_buffer() for x in t.column("x")]       # not copied
            rows = with_columns(unpack_rows([raw[i] for i in order], LEAST), extra)
            train, test = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
            index = worth(rows if len(train) == len(rows) else rows.take(train), label[train], k)
            rows = restrict(rows, index)                       # few are left, before anything else is made of them
            q = fit_few(rows.take(train), len(index), label[train])
            few = rows.take(test)
            p = sigmoid(few.dot(q[:-1]) + q[-1]) if len(test) else np.zeros(0)
            w = np.zeros(DIM + k + 1)
            w[index], w[-1] = q[:-1], q[-1]
            final = part == folds
            return pa.table({"row": pa.array(number[test], pa.int64()), "p": pa.array(p),
                             "w": pa.array([None] * len(test), pa.binary())}) if not final else pa.table(
                {"row": pa.array([-1], pa.int64()), "p": pa.array([0.0]), "w": pa.array([w.tobytes()], pa.binary())})

        if k == 0:
            current = cut_lineage(current.withColumn("row", F.monotonically_increasing_id()))
        parts = current.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(folds))))
        found = cut_lineage(parts.groupBy("part").applyInArrow(tidy(learn), "row long, p double, w binary"))
        final = found.where("row < 0").select("w").collect()
        if not final:
            return []
        chain.append(np.frombuffer(final[0]["w"]))
        out_of_fold = found.where("row >= 0").select("row", "p")
        current = cut_lineage(current.join(out_of_fold, "row").withColumn(
            "seen", F.concat("seen", F.array("p"))).drop("p"))
    return chain


def chain_probabilities(df: DataFrame, labels: DataFrame, categories: dict[str, Column], id: str = "doc_id",
                        text: str = "text", train_rows: int = TRAIN_ROWS, folds: int = FOLDS) -> Column:
    """A column over ``df``: an array with the probability of each category, in the order of the chain.

    ``categories``: for each a boolean over the columns of ``labels`` and ``_text`` (the document's text); a null
    counts as false. Labels without an id, or whose document does not exist, are not used; a document labelled twice
    counts twice. Without usable labels every probability is 0. A null or empty text is scored by the intercepts. Texts
    are read whole. Other columns of ``df`` are neither read nor changed.
    """
    spark = df.sparkSession
    names = list(categories)
    sample = labelled_sample(df, labels, categories, id, text, train_rows)
    held = spark.sparkContext.broadcast(train_chain(sample, names, folds))

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        out: list = []
        used = np.any([w[:DIM] != 0 for w in held.value], axis=0) if held.value else None
        for at in range(0, len(texts), STEP):
            part = texts.slice(at, STEP)
            if not held.value:
                out.extend([[0.0] * len(names)] * len(part))
                continue
            x = features(part, used)
            seen = np.zeros((len(part), 0))
            for w in held.value:
                seen = np.column_stack([seen, predict(with_columns(x, seen), w)])
            out.extend(seen.tolist())
        give_back()
        return pa.array(out, pa.list_(pa.float64()))

    return score(F.col(f"`{text}`"))


def labelled_sample(df: DataFrame, labels: DataFrame, categories: dict[str, Column], id: str, text: str,
                    rows: int) -> DataFrame:
    usable = labels.drop("_text").join(df.select(F.col(f"`{id}`").alias(id)), id, "left_semi")
    # a label is unknown when it leaves a category unknown whatever the text
    usable = usable.withColumn("_text", F.lit(""))
    for c in categories.values():
        usable = usable.where(c.isNotNull())
    usable = usable.drop("_text")
    few = usable.orderBy(F.xxhash64(F.col(f"`{id}`")), *[F.col(f"`{c}`") for c in labels.columns]).limit(rows)
    docs = df.select(F.col(f"`{id}`").alias(id), F.col(f"`{text}`").alias("_text"))
    marked = docs.join(F.broadcast(few), id).select(
        F.col(f"`{id}`").alias("id"), F.col("_text").alias("text"),
        F.array(*[F.coalesce(c, F.lit(False)) for c in categories.values()]).alias("label"))
    return marked.select("id", "label", packed(F.col("text")).alias("x"))
