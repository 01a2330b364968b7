"""k-NN, cluster and classification-report queries over
``embeddings`` (64-dim unit vectors, label 0-9), with DuckDB oracles.

The k-NN job is the reference's: stratified 80/20 split, standardise on the training part, 5 neighbours,
majority vote. The three metric queries score its predictions.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import encode as E
from quarry.operators import evaluate as V
from quarry.operators import neighbours as N
from quarry.operators import sampling as X
from quarry.plans.sample_jobs import SEED, TEST_SIZE, md5_rank, quota_sql
from quarry.plans.tables import table
from quarry.session import cut_lineage

K = 5
POSITIVE = 1


def r6(c):
    return F.round(c, 6)


def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))


def knn_predictions(spark, sf_dir, k: int = K):
    """``(vec_id, label, prediction)`` for the test part."""
    split = cut_lineage(X.stratified_split(_embeddings(spark, sf_dir), "label", ["vec_id"], TEST_SIZE, SEED))
    train, test = split.where(F.col("split") == "train"), split.where(F.col("split") == "test")
    scaler = E.fit_array_scaler(train, "embedding")
    pred = N.knn_predict(scaler.transform(test), scaler.transform(train), "vec_id", "features", "label", k)
    return test.select("vec_id", "label").join(pred, "vec_id")


def q_knn_predict(spark, sf_dir):
    return knn_predictions(spark, sf_dir).select("vec_id", F.col("label").cast("int").alias("label"), "prediction")


def q_confusion(spark, sf_dir):
    return V.confusion(knn_predictions(spark, sf_dir), "label", "prediction").select(
        F.col("actual").cast("int").alias("actual"), F.col("predicted").cast("int").alias("predicted"), "count")


def q_class_report(spark, sf_dir):
    rep = V.class_report(knn_predictions(spark, sf_dir), "label", "prediction")
    return rep.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), "support")


def q_binary_metrics(spark, sf_dir):
    m = V.binary_metrics(knn_predictions(spark, sf_dir), POSITIVE, "label", "prediction")
    return m.select(*[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def q_model_comparison(spark, sf_dir):
    accs = None
    for k in (1, K):
        a = V.accuracy(knn_predictions(spark, sf_dir, k), "label", "prediction").select(
            F.lit(f"knn_k{k}").alias("model"), "accuracy")
        accs = a if accs is None else accs.unionByName(a)
    whole = Window.partitionBy()   # two rows
    best = F.max("accuracy").over(whole)
    n_best = F.sum(F.when(F.col("accuracy") == best, 1).otherwise(0)).over(whole)
    verdict = (F.when((F.col("accuracy") == best) & (n_best > 1), "tie")
               .when(F.col("accuracy") == best, "winner").otherwise("lower"))
    return accs.select("model", r6("accuracy").alias("accuracy"), verdict.alias("verdict"))


def _scaled_all(spark, sf_dir):
    e = _embeddings(spark, sf_dir)
    return E.fit_array_scaler(e, "embedding").transform(e)


def q_inertia_k1(spark, sf_dir):
    """C2 at k = 1 (Spark's KMeans rejects k = 1): squared deviation from the centroid of the scaled data."""
    z = _scaled_all(spark, sf_dir).select(F.posexplode("features").alias("i", "x"))
    per_dim = z.groupBy("i").agg((F.count(F.lit(1)) * F.var_pop("x")).alias("ss"))
    return per_dim.agg(F.lit(1).alias("k"), r6(F.sum("ss")).alias("inertia"))


def q_rand_index(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", (F.col("vec_id") % 3).alias("group3"))
    return V.adjusted_rand_index(e, "label", "group3").select(r6("ari").alias("ari"))


def q_silhouette_exact(spark, sf_dir):
    s = N.silhouette(_scaled_all(spark, sf_dir), "vec_id", "features", "label")
    return s.agg(F.count(F.lit(1)).alias("points"), r6(F.avg("s")).alias("silhouette"))


def q_silhouette_squared(spark, sf_dir):
    s = N.silhouette_squared(_scaled_all(spark, sf_dir), "vec_id", "features", "label")
    return s.agg(F.count(F.lit(1)).alias("points"), r6(F.avg("s")).alias("silhouette"))


QUERIES = {
    "knn_predict": q_knn_predict,
    "confusion": q_confusion,
    "class_report": q_class_report,
    "binary_metrics": q_binary_metrics,
    "model_comparison": q_model_comparison,
    "inertia_k1": q_inertia_k1,
    "rand_index": q_rand_index,
    "silhouette_exact": q_silhouette_exact,
    "silhouette_squared": q_silhouette_squared,
}


# ---------------------------------------------------------------------------------------------------------
# DuckDB oracle SQL

LONG_SQL = """e AS (SELECT vec_id, label, embedding FROM embeddings),
    long AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM e)"""


def knn_sql(k: int, name: str = "pred") -> str:
    """CTEs ending in ``{name}(vec_id, label, prediction)`` (needs LONG_SQL and the split CTEs)."""
    return f"""{name}_d AS (
        SELECT q.vec_id AS qk, b.vec_id AS bk, b.label AS lab, round(sqrt(sum((q.z - b.z) * (q.z - b.z))), 9) AS dist
        FROM zt q JOIN zt b ON q.i = b.i AND q.split = 'test' AND b.split = 'train' GROUP BY q.vec_id, b.vec_id, b.label),
    {name}_nn AS (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY dist, bk) AS rn FROM {name}_d),
    {name}_v AS (SELECT qk, lab, count(*) AS v FROM {name}_nn WHERE rn <= {k} GROUP BY qk, lab),
    {name}_p AS (SELECT qk, lab, row_number() OVER (PARTITION BY qk ORDER BY v DESC, lab) AS r FROM {name}_v),
    {name} AS (SELECT sp.vec_id, CAST(sp.label AS INTEGER) AS label, CAST(p.lab AS INTEGER) AS prediction
               FROM sp JOIN {name}_p p ON sp.vec_id = p.qk AND p.r = 1)"""


SPLIT_SQL = f"""{LONG_SQL}, {quota_sql('e', 'label')},
    r AS (SELECT vec_id, label, {md5_rank('vec_id', 'label')} AS rk FROM e),
    sp AS (SELECT r.vec_id, r.label, CASE WHEN r.rk <= q.quota THEN 'test' ELSE 'train' END AS split
           FROM r JOIN quota q ON r.label = q.label),
    stats AS (SELECT l.i, avg(l.x) AS m, stddev_pop(l.x) AS s FROM long l JOIN sp ON l.vec_id = sp.vec_id
              WHERE sp.split = 'train' GROUP BY l.i),
    zt AS (SELECT l.vec_id, l.i, (l.x - st.m) / CASE WHEN st.s = 0 THEN 1 ELSE st.s END AS z, sp.label, sp.split
           FROM long l JOIN stats st ON l.i = st.i JOIN sp ON l.vec_id = sp.vec_id)"""

KNN_CTE = f"WITH {SPLIT_SQL}, {knn_sql(K)}"

SCALED_ALL_SQL = f"""{LONG_SQL},
    stats AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY i),
    z AS (SELECT l.vec_id, l.i, (l.x - st.m) / CASE WHEN st.s = 0 THEN 1 ELSE st.s END AS z
          FROM long l JOIN stats st ON l.i = st.i)"""



def silhouette_sql(distance: str) -> str:
    return f"""WITH {SCALED_ALL_SQL},
    lab AS (SELECT vec_id, label FROM embeddings),
    d AS (SELECT q.vec_id AS qk, b.vec_id AS bk, {distance} AS dist
          FROM z q JOIN z b ON q.i = b.i GROUP BY q.vec_id, b.vec_id),
    per AS (SELECT d.qk, lb.label AS c, sum(d.dist) AS sum_d, count(*) AS cnt FROM d JOIN lab lb ON d.bk = lb.vec_id
            GROUP BY d.qk, lb.label),
    ab AS (SELECT per.qk, max(CASE WHEN per.c = lq.label THEN sum_d / (cnt - 1) END) AS a,
                  max(CASE WHEN per.c = lq.label THEN cnt END) AS own_n,
                  min(CASE WHEN per.c <> lq.label THEN sum_d / cnt END) AS b
           FROM per JOIN lab lq ON per.qk = lq.vec_id GROUP BY per.qk)
    SELECT count(*) AS points, round(avg(CASE WHEN own_n <= 1 OR b IS NULL THEN 0.0
                                              ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab"""


SQL = {
    "knn_predict": KNN_CTE + "\n    SELECT vec_id, label, prediction FROM pred",
    "confusion": KNN_CTE + """,
    labs AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
    cnt AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL)
    SELECT CAST(a.c AS INTEGER) AS actual, CAST(b.c AS INTEGER) AS predicted, CAST(coalesce(cnt.n, 0) AS BIGINT) AS count
    FROM labs a CROSS JOIN labs b LEFT JOIN cnt ON cnt.label = a.c AND cnt.prediction = b.c""",
    "class_report": KNN_CTE + """,
    labs AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
    pc0 AS (SELECT c, (SELECT count(*) FROM pred WHERE label = c AND prediction = c) AS tp,
                   (SELECT count(*) FROM pred WHERE label = c) AS support,
                   (SELECT count(*) FROM pred WHERE prediction = c) AS pn FROM labs),
    pc1 AS (SELECT c, tp, support, CASE WHEN pn = 0 THEN 0.0 ELSE tp / pn END AS precision,
                   CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM pc0),
    pc AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                          ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc1)
    SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc
    UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                     CAST(sum(support) AS BIGINT) FROM pc
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                     round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                     CAST(sum(support) AS BIGINT) FROM pc""",
    "binary_metrics": KNN_CTE + f""",
    c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = {POSITIVE} AND prediction = {POSITIVE}) AS tp,
                 count(*) FILTER (WHERE label <> {POSITIVE} AND prediction = {POSITIVE}) AS fp,
                 count(*) FILTER (WHERE label = {POSITIVE} AND prediction <> {POSITIVE}) AS fn,
                 count(*) FILTER (WHERE label = prediction) AS hits FROM pred),
    m AS (SELECT hits / n AS accuracy, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
                 CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM c)
    SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6)
           AS f1 FROM m""",
    "model_comparison": f"WITH {SPLIT_SQL}, {knn_sql(1, 'p1')}, {knn_sql(K, 'p5')}" + f""",
    accs AS (SELECT 'knn_k1' AS model, avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM p1
             UNION ALL SELECT 'knn_k{K}', avg(CAST(label = prediction AS DOUBLE)) FROM p5),
    b AS (SELECT max(accuracy) AS best FROM accs),
    nb AS (SELECT count(*) AS n_best FROM accs, b WHERE accuracy = best)
    SELECT model, round(accuracy, 6) AS accuracy,
           CASE WHEN accuracy = best AND n_best > 1 THEN 'tie' WHEN accuracy = best THEN 'winner' ELSE 'lower' END
           AS verdict FROM accs, b, nb""",
    "inertia_k1": f"""WITH {SCALED_ALL_SQL}
    SELECT 1 AS k, round(sum(ss), 6) AS inertia FROM (SELECT i, count(*) * var_pop(z) AS ss FROM z GROUP BY i)""",
    "rand_index": """WITH c AS (SELECT label AS a, vec_id % 3 AS b, count(*) AS n FROM embeddings GROUP BY ALL),
    t AS (SELECT (SELECT sum(n * n) FROM c) AS S, (SELECT sum(s * s) FROM (SELECT sum(n) AS s FROM c GROUP BY a)) AS A,
                 (SELECT sum(s * s) FROM (SELECT sum(n) AS s FROM c GROUP BY b)) AS B, (SELECT sum(n) FROM c) AS N),
    p AS (SELECT CAST(S - N AS DOUBLE) AS tp, CAST(B - S AS DOUBLE) AS fp, CAST(A - S AS DOUBLE) AS fn,
                 CAST(N AS DOUBLE) * CAST(N AS DOUBLE) - CAST(B - S AS DOUBLE) - CAST(A - S AS DOUBLE) - CAST(S AS DOUBLE) AS tn
          FROM t)
    SELECT round(CASE WHEN fn = 0 AND fp = 0 THEN 1.0
                      ELSE 2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) END, 6) AS ari FROM p""",
    "silhouette_exact": silhouette_sql("sqrt(sum((q.z - b.z) * (q.z - b.z)))"),
    "silhouette_squared": silhouette_sql("sum((q.z - b.z) * (q.z - b.z))"),
}
