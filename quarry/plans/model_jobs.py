"""Model queries — rows-only checks: fitted models are not SQL-expressible.

Inputs (FIXTURES §2): multi-class text = ``documents`` (label = language), imbalanced tabular =
``orders`` ⋈ ``customer`` (label = urgent priority, balanced by undersampling as the reference does),
measures = ``embeddings``; the fused classifier joins two blocks of the documents, look and TF-IDF, per id.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import encode as E
from quarry.operators import evaluate as V
from quarry.operators import models as M
from quarry.operators import sampling as X
from quarry.operators.network import Block
from quarry.plans.neighbour_jobs import _embeddings
from quarry.plans.sample_jobs import SEED, TEST_SIZE, _urgent_orders
from quarry.session import cut_lineage, stored

TEXT_FEATURES = 5000
FUSED_TEXT_FEATURES = 500


def r6(c):
    return F.round(c, 6)


def _doc_features(spark, sf_dir, folds=False):
    """``doc_id, label, features, split``, and with ``folds`` the ``fold`` of the training rows."""
    from quarry.operators import text as T
    from quarry.plans.tables import text_table

    docs = text_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    coded, _ = E.label_encode(docs, "lang", "label")
    # the split looks at keys and labels only, and deals the texts before they become tokens
    split = X.stratified_split(coded.select("doc_id", "label", "text"), "label", ["doc_id"], TEST_SIZE, SEED)
    clean = split.select("doc_id", "label", "split", tx.clean_tokens("text").alias("tokens"))
    # the reference stems the cleaned tokens (T7), and its vectorizer then ignores 1-character stems
    stems = T.stem_tokens(clean, "doc_id", F.col("tokens"), ("label", "split"))
    # read by several jobs below (counts, vocabulary, vectors): written once, without the bigrams, which are many times as large
    stems = stored(stems.select("doc_id", "label", "split", F.filter("stems", lambda x: F.length(x) >= 2).alias("tokens")), "stems")
    words = T.frequent_words(stems.where("split = 'train'"), F.col("tokens"), TEXT_FEATURES)
    grams = T.words_and_pairs(stems, "tokens", words, "grams")
    # vocabulary and idf are those of the training part
    feats = M.tfidf_features(grams, "doc_id", "grams", TEXT_FEATURES, fit_on=grams.where("split = 'train'"))
    feats = feats.select("doc_id", "label", "features", "split")
    if folds:
        feats = X.kfold(feats.where("split = 'train'"), "label", ["doc_id"], 5, SEED).unionByName(
            feats.where("split = 'test'").withColumn("fold", F.lit(None).cast("int")))
    return stored(feats, "features")


def _predictions(model, test, key):
    return model.transform(test).select(key, F.col("label").cast("int").alias("label"),
                                        F.col("prediction").cast("int").alias("prediction"))


def q_logreg_multi(spark, sf_dir):
    d = _doc_features(spark, sf_dir)
    model = M.logistic_regression(d.where("split = 'train'"), multinomial=True, max_iter=1000)
    return _predictions(model, d.where("split = 'test'"), "doc_id")


def q_svm_ovr(spark, sf_dir):
    d = _doc_features(spark, sf_dir)
    model = M.linear_svm_ovr(d.where("split = 'train'"))
    return _predictions(model, d.where("split = 'test'"), "doc_id")


def _lr(train):
    return M.logistic_regression(train, multinomial=True, max_iter=1000)


def _svm(train):
    return M.linear_svm_ovr(train)


def _cv_rows(scores):
    accs = np.array([a for _, a in scores])
    return round(float(accs.mean()), 6), round(float(2 * accs.std()), 6)


def q_cv_scores(spark, sf_dir):
    """V5: 5-fold stratified CV accuracy on the training part: per fold, plus mean and 2·std (population)."""
    train = _doc_features(spark, sf_dir, folds=True).where("split = 'train'")
    scores = M.cross_validate(train, _lr)
    mean, two_std = _cv_rows(scores)
    rows = [(f, round(a, 6), mean, two_std) for f, a in scores]
    return spark.createDataFrame(rows, "fold int, accuracy double, cv_mean double, cv_2std double")


def q_text_model_comparison(spark, sf_dir):
    """Logistic regression against the linear SVM on the same split and folds: hold-out accuracy, CV mean and
    2·std, verdict by hold-out accuracy."""
    d = _doc_features(spark, sf_dir, folds=True)
    train = d.where("split = 'train'")
    rows = []
    for name, fit in (("logistic_regression", _lr), ("linear_svm", _svm)):
        held = V.accuracy(fit(train).transform(d.where("split = 'test'")), "label", "prediction").first()["accuracy"]
        rows.append((name, round(float(held), 6), *_cv_rows(M.cross_validate(train, fit))))
    table = spark.createDataFrame(rows, "model string, accuracy double, cv_mean double, cv_2std double")
    return M.rank_models(table, "accuracy")


def _churn_like(spark, sf_dir, stratified=True):
    """Balanced urgent-order table with drop-first one-hot features (the churn jobs' preparation)."""
    # written once: the categories of every text column, and the split, read the drawn rows
    df = stored(X.undersample(_urgent_orders(spark, sf_dir), "urgent", ["o_orderkey"], SEED), "drawn")
    df = E.onehot_drop_first(df, E.text_columns(df), max_categories=100)
    feats = [c for c in df.columns if c not in ("o_orderkey", "urgent")]
    df = VectorAssembler(inputCols=feats, outputCol="features").transform(df).select(
        "o_orderkey", F.col("urgent").alias("label"), "features")
    split = (X.stratified_split(df, "label", ["o_orderkey"], TEST_SIZE, SEED) if stratified
             else X.plain_split(df, ["o_orderkey"], TEST_SIZE, SEED))
    return cut_lineage(split)


def q_logreg_binary(spark, sf_dir):
    d = _churn_like(spark, sf_dir)
    model = M.logistic_regression(d.where("split = 'train'"), multinomial=False, max_iter=2000)
    return _predictions(model, d.where("split = 'test'"), "o_orderkey")


def q_forest(spark, sf_dir):
    d = _churn_like(spark, sf_dir)
    model = M.random_forest(d.where("split = 'train'"))
    return _predictions(model, d.where("split = 'test'"), "o_orderkey")


def q_tree(spark, sf_dir):
    d = _churn_like(spark, sf_dir, stratified=False)
    model = M.decision_tree(d.where("split = 'train'"))
    return _predictions(model, d.where("split = 'test'"), "o_orderkey")


def q_tree_nodes(spark, sf_dir):
    d = _churn_like(spark, sf_dir, stratified=False)
    return M.tree_nodes(M.decision_tree(d.where("split = 'train'")), 3)


def _scaled_vectors(spark, sf_dir):
    e = _embeddings(spark, sf_dir)
    z = E.fit_array_scaler(e, "embedding").transform(e)
    return z.select("vec_id", "label", "embedding", "features", E.to_vector("features").alias("vec"))


def q_kmeans_clusters(spark, sf_dir):
    out, _ = M.kmeans(_scaled_vectors(spark, sf_dir), "vec", k=3, seed=SEED)
    return out.select("vec_id", "cluster", "cluster_name")


def q_cluster_profile(spark, sf_dir):
    """V8 / A10: k-means clusters (k = 3) profiled by the mean of every numeric column: one row per cluster and
    embedding dimension, and one for the label."""
    out, _ = M.kmeans(_scaled_vectors(spark, sf_dir), "vec", k=3, seed=SEED)
    long = out.select("cluster", F.explode(F.concat(
        F.transform("embedding", lambda x, i: F.struct(F.concat(F.lit("e"), i.cast("string")).alias("column"),
                                                       x.alias("x"))),
        F.array(F.struct(F.lit("label").alias("column"), F.col("label").cast("double").alias("x"))))).alias("c"))
    return long.groupBy("cluster", "c.column").agg(r6(F.avg("c.x")).alias("mean"), F.count(F.lit(1)).alias("n"))


def q_elbow(spark, sf_dir):
    rows = M.elbow(_scaled_vectors(spark, sf_dir), "features", range(1, 11))
    return spark.createDataFrame(rows, "k int, inertia double")


def q_pca_2d(spark, sf_dir):
    p = E.pca_2d(_scaled_vectors(spark, sf_dir), "vec", 2, "pca")
    return p.select("vec_id", F.col("pca")[0].alias("pc1"), F.col("pca")[1].alias("pc2"))


def _projection(x: np.ndarray) -> np.ndarray:
    """A fixed user batch function: a seeded random projection to 8 features with a ReLU."""
    w = np.random.default_rng(42).standard_normal((x.shape[1], 8))
    return np.maximum(x @ w, 0.0)


def q_batch_features(spark, sf_dir):
    return M.batch_features(_embeddings(spark, sf_dir), "vec_id", "embedding", _projection, 8, batch_size=32)


def _shape(c: str):
    """What a text looks like: its length and the shares of some kinds of characters, six numbers."""
    n = F.greatest(F.length(c), F.lit(1))
    share = lambda p: F.length(F.regexp_replace(F.col(c), p, "")) / n  # noqa: E731  the characters that p leaves
    return F.array(F.log1p(F.length(c).cast("double")), share("[^A-Z]"), share("[^0-9]"), share("[^\\n]"), share("[^ ]"),
                   share("[A-Za-z0-9\\s]"))


def _fused(spark, sf_dir):
    """J6 + C11: two blocks of the same documents, the look of the text and its TF-IDF (500 terms, 1+ char tokens, of
    the training part), joined on the document. Every document takes part."""
    from quarry.plans.tables import text_table

    docs = text_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    coded, _ = E.label_encode(docs.select(
        "doc_id", "lang", tx.word_tokens("text", tx.TOKEN_1PLUS).alias("tokens")), "lang", "label")
    coded = stored(coded, "coded")       # the split reads its rows twice
    split = cut_lineage(X.stratified_split(coded, "label", ["doc_id"], TEST_SIZE, SEED))
    text = M.tfidf_features(split, "doc_id", "tokens", FUSED_TEXT_FEATURES, "txt", split.where("split = 'train'"))
    look = docs.select("doc_id", E.to_vector(_shape("text")).alias("look"))
    joined = cut_lineage(text.select("doc_id", "label", "txt", "split").join(look, "doc_id"))
    train, held = joined.where("split = 'train'"), joined.where("split = 'test'")
    # as in the reference, the held-out part says when to stop
    model = M.fused_network(train, held, [Block("look", 256, 0.5), Block("txt", 128, 0.3)], "doc_id", seed=SEED)
    return model.transform(held).select(
        "doc_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), "probability")


def q_fused_classifier(spark, sf_dir):
    return _fused(spark, sf_dir).select("doc_id", "label", "prediction")


def q_holdout_loss(spark, sf_dir):
    p = _fused(spark, sf_dir)
    loss = V.log_loss(p, "probability", "label")
    acc = V.accuracy(p, "label", "prediction").first()["accuracy"]
    return loss.select(r6("loss").alias("loss"), F.lit(round(acc, 6)).alias("accuracy"), "rows")


QUERIES = {
    "logreg_multi": q_logreg_multi,
    "svm_ovr": q_svm_ovr,
    "cv_scores": q_cv_scores,
    "text_model_comparison": q_text_model_comparison,
    "logreg_binary": q_logreg_binary,
    "forest": q_forest,
    "tree": q_tree,
    "tree_nodes": q_tree_nodes,
    "kmeans_clusters": q_kmeans_clusters,
    "cluster_profile": q_cluster_profile,
    "elbow": q_elbow,
    "pca_2d": q_pca_2d,
    "batch_features": q_batch_features,
    "fused_classifier": q_fused_classifier,
    "holdout_loss": q_holdout_loss,
}

SQL: dict[str, str] = {}
