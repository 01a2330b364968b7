"""Golden cases: thresholds, separators in names, null classes and categories, large counts, batch sizes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import baskets as B
from quarry.operators import encode as E
from quarry.operators import evaluate as V
from quarry.operators import models as M
from quarry.operators import sampling as X


def _pairs(spark, baskets):
    return spark.createDataFrame([(b, i) for b, items in baskets.items() for i in items], "b string, item string")


def test_both_miners_agree_at_the_threshold(spark):
    # 7 of 100 at support 0.07: 0.07 * 100 is a little over 7 in floating point
    pairs = _pairs(spark, {str(i): (["x", "y"] if i < 7 else ["z"]) for i in range(100)})
    level = B.frequent_itemsets_levelwise(pairs, ["b"], 0.07, 3)
    grown = B.frequent_itemsets_fpgrowth(pairs, ["b"], 0.07, 3)
    assert sorted(r["freq"] for r in level.where("size = 2").collect()) == [7]
    cols = ["items", "freq", "size"]
    assert level.select(cols).exceptAll(grown.select(cols)).count() == 0
    assert grown.select(cols).exceptAll(level.select(cols)).count() == 0


def test_recommendations_do_not_mix_names_that_hold_separators(spark):
    rules = spark.createDataFrame(
        [(["a|b"], ["c"], 0.9, 5.0, 0.1), (["a", "b"], ["c"], 0.5, 2.0, 0.1), (["a=>b"], ["d"], 0.5, 7.0, 0.1),
         (["a"], ["b|d"], 0.5, 1.5, 0.1)],
        "antecedents array<string>, consequents array<string>, confidence double, lift double, support double")
    pairs = _pairs(spark, {"1": ["a", "b"], "2": ["a|b"]})
    got = {(r["b"], r["item"]): r["lift"] for r in B.recommend(pairs, ["b"], rules, 5).collect()}
    assert got == {("1", "c"): 2.0, ("1", "b|d"): 1.5, ("2", "c"): 5.0}


def test_recommend_deals_the_baskets_once(spark):
    rules = spark.createDataFrame(
        [(["a"], ["c"], 0.9, 5.0, 0.1)],
        "antecedents array<string>, consequents array<string>, confidence double, lift double, support double")
    plan = B.recommend(_pairs(spark, {"1": ["a", "b"]}), ["b"], rules, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


def test_null_category_is_zero_in_every_dummy(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, c string")
    assert E.text_columns(df) == ["c"]
    rows = {r["id"]: (r["c_b"], r["c_c"]) for r in E.onehot_drop_first(df, ["c"], 10).collect()}
    assert rows == {1: (0, 0), 2: (1, 0), 3: (0, 1), 4: (0, 0)}
    with pytest.raises(ValueError):
        E.onehot_drop_first(df, ["c"], 2)
    vec = {r["id"]: list(r["v"].toArray()) for r in E.onehot_vector(df, "c", "v").collect()}
    assert vec == {1: [0, 0], 2: [0, 1], 3: [1, 0], 4: [0, 0]}


def test_rand_index_takes_large_groups(spark):
    # one group of 2**32 rows by its count: the squares do not fit a long
    big = spark.range(1).select(F.lit(2 ** 32).alias("n"))
    assert big.select((F.col("n").cast("double") * F.col("n").cast("double")).alias("q")).first()["q"] == 2.0 ** 64
    df = spark.createDataFrame([(0, 0)] * 3 + [(1, 1)] * 2 + [(0, 1)], "a int, b int")
    plan = V.adjusted_rand_index(df, "a", "b")._jdf.queryExecution().analyzed().toString()
    assert "cast(n" in plan and "double" in plan
    pairs = [(0, 0)] * 3 + [(1, 1)] * 2 + [(0, 1)]
    c = lambda n: n * (n - 1) / 2
    same, a, b, total = c(3) + c(2) + c(1), c(4) + c(2), c(3) + c(3), c(len(pairs))
    want = (same - a * b / total) / ((a + b) / 2 - a * b / total)
    assert abs(V.adjusted_rand_index(df, "a", "b").first()["ari"] - want) < 1e-12


def test_batches_have_the_size_asked_for_and_no_setting_changes(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    df = spark.range(100).select(F.col("id").alias("k"), F.array(F.col("id").cast("double")).alias("x")).coalesce(1)

    def size(x: np.ndarray) -> np.ndarray:
        return np.full((len(x), 1), len(x))

    sizes = [r["feats"][0] for r in M.batch_features(df, "k", "x", size, 1, batch_size=32).collect()]
    assert spark.conf.get(key) == before
    assert sorted(set(sizes)) == [4.0, 32.0] and len(sizes) == 100


def test_null_labels_stay_in_splits_and_folds(spark):
    df = spark.range(20).select("id", F.when(F.col("id") < 17, (F.col("id") % 2).cast("string")).alias("label"))
    split = X.stratified_split(df, "label", ["id"], 0.2).collect()
    assert len(split) == 20 and sum(r["split"] == "test" for r in split) == math.ceil(0.2 * 20)
    assert X.kfold(df, "label", ["id"], 5).count() == 20


def test_quota_agrees_with_full_rank(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    kept = X.undersample(df, "label", ["id"])
    m = df.where("label = 1").count()
    want = X.hash_rank(df, ["id"], 42, ["label"], "undersample").where(F.col("_rank") <= m)
    assert kept.select("id").exceptAll(want.select("id")).count() == 0 and kept.count() == 2 * m
    part = X.plain_split(kept, ["id"], 0.2)
    share = part.where("split = 'test'").agg(F.avg("label")).first()[0]
    assert abs(share - 0.5) < 0.06   # not the majority that a reused hash would give


def test_only_boundary_buckets_are_shuffled(spark):
    df = spark.range(100_000)
    split = X.plain_split(df, ["id"], 0.2)
    assert split.where("split = 'test'").count() == 20_000
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_listing_and_append(spark, tmp_path):
    from quarry.sources import files

    for n in ("a.png", "b.PNG", "c.txt"):
        (tmp_path / n).write_text("x")
    assert sorted(r["stem"] for r in files.list_files(spark, str(tmp_path)).collect()) == ["a", "b"]
    rows = spark.range(3).select("id")
    path = str(tmp_path / "kept")
    assert files.replace_collection(rows, path) == 3 and files.append_collection(rows, path) == 3
    assert files.read_collection(spark, path, "id long").groupBy("id").count().where("count = 2").count() == 3


def test_cross_validation_scores_every_fold(spark):
    rows = [(float(i % 2), [float(i % 2), float(i % 5)], i % 5) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, x array<double>, fold int").select(
        "label", "fold", E.to_vector("x").alias("features"))
    scores = M.cross_validate(df, lambda t: M.logistic_regression(t, multinomial=False))
    assert [f for f, _ in scores] == list(range(5)) and all(a == 1.0 for _, a in scores)


def test_stems_of_the_extended_mode(spark):
    from quarry.functions.stem import cv_pattern, stem_column

    words = ("caresses flies dies mules denied died agreed owned humbled sized meeting stating siezing itemization "
             "sensational traditional reference colonizer plotted sky skies dying news happy enjoy using tied spied ties "
             "technology rationally by possibly successfully generously")
    want = ("caress fli die mule deni die agre own humbl size meet state siez item sensat tradit refer colon plot sky sky "
            "die news happi enjoy use tie spi tie technolog ration by possibl success gener")
    df = spark.createDataFrame([(w,) for w in words.split()] + [(None,)], "w string")
    got = {r["w"]: r["stem"] for r in stem_column(df, "w", extended=True).collect()}
    assert got.pop(None) is None
    assert got == dict(zip(words.split(), want.split()))
    runs = spark.createDataFrame([("ayyyyyyb",), ("yyyyyya",), ("byyyyyy",)], "w string")
    assert [r[0] for r in runs.select(cv_pattern(F.col("w"))).collect()] == ["VCVCVCVC", "CVCVCVV", "CVCVCVC"]
