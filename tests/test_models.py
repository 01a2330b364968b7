"""Properties of the fitted-model queries on the smallest tables (no SQL can give their rows)."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import models as M
from quarry.operators import text as T
from quarry.plans import text_jobs
from quarry.plans.registry import QUERIES, SQL
from quarry.session import cut_lineage

SLOW = {"cv_scores", "text_model_comparison", "svm_ovr", "logreg_multi"}   # many fits: run_oracle.py runs them


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_query_gives_rows(spark, small_dir, name):
    assert QUERIES[name](spark, small_dir).limit(1).count() == 1


def test_inertia_never_rises(spark, small_dir):
    curve = [r["inertia"] for r in QUERIES["elbow"](spark, small_dir).orderBy("k").collect()]
    assert len(curve) == 10 and all(b <= a * 1.02 for a, b in zip(curve, curve[1:]))


def test_components_are_centred_and_uncorrelated(spark, small_dir):
    p = np.array([(r["pc1"], r["pc2"]) for r in QUERIES["pca_2d"](spark, small_dir).collect()])
    assert abs(p.mean(0)).max() < 1e-9 and abs(np.corrcoef(p.T)[0, 1]) < 1e-9


def test_profile_has_every_dimension_and_every_row(spark, small_dir):
    rows = QUERIES["cluster_profile"](spark, small_dir).collect()
    assert {r["column"] for r in rows} == {"label", *[f"e{i}" for i in range(64)]}
    n = spark.read.parquet(f"{small_dir}/embeddings.parquet").count()
    assert sum(r["n"] for r in rows if r["column"] == "label") == n


def test_fused_classifier_sees_every_document_and_beats_the_majority(spark, small_dir):
    p = QUERIES["fused_classifier"](spark, small_dir).collect()
    n = spark.read.parquet(f"{small_dir}/documents.parquet").count()
    assert len(p) == math.ceil(0.2 * n)
    labels = [r["label"] for r in p]
    assert np.mean([r["label"] == r["prediction"] for r in p]) > max(map(labels.count, set(labels))) / len(labels)


def test_vectors_hold_the_long_weights(spark, small_dir):
    docs = cut_lineage(text_jobs._clean_docs(spark, small_dir).select("doc_id", tx.with_bigrams("tokens").alias("g")))
    part = docs.where("doc_id % 2 = 0")
    vec = M.tfidf_features(docs, "doc_id", "g", 200, fit_on=part).select("doc_id", vector_to_array("features").alias("v"))
    long = T.tfidf(docs, "doc_id", F.col("g"), 200, fit_on=part)
    a = {r["doc_id"]: sorted(round(x, 9) for x in r["v"] if x) for r in vec.collect()}
    b: dict = {}
    for r in long.collect():
        b.setdefault(r["doc_id"], []).append(round(r["weight"], 9))
    assert {d: w for d, w in a.items() if w} == {d: sorted(w) for d, w in b.items()}
    assert all(abs(sum(x * x for x in w) - 1) < 1e-6 for w in a.values() if w)


@pytest.mark.parametrize("fit", [M.random_forest, lambda t: M.logistic_regression(t, multinomial=False)])
def test_models_of_two_classes_score_after_an_observation(spark, fit):
    # the observation gives the session a part that cannot be serialised, and a training summary holds the session
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    df = spark.createDataFrame([(float(i % 2), [float(i % 2), float(i % 5)]) for i in range(60)], "label double, x array<double>")
    df = df.select("label", array_to_vector("x").alias("features"))
    rows = fit(df).transform(df).select("label", "prediction").collect()
    assert len(rows) == 60 and all(r["label"] == r["prediction"] for r in rows)
