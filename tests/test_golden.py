"""Golden micro-tables (FIXTURES §4): quirks, null rules, zero division, ties, empty input."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import scalar as S
from quarry.functions import text as tx
from quarry.operators import baskets as B
from quarry.operators import evaluate as V
from quarry.operators import neighbours as N
from quarry.operators import profile as P
from quarry.operators import sampling as X


def test_text_cleaning_edge_cases(spark):
    rows = [(1, "@aüb x"), (2, "see http://a.b/c and www.d.e ok"), (3, "Été déjà naïve words"),
            (4, "!!! ???"), (5, ""), (6, "don't stop"), (7, "tab\there nbsp word"), (8, "single")]
    df = spark.createDataFrame(rows, "id int, text string")
    out = {r["id"]: r["c"] for r in df.select("id", tx.clean_text("text").alias("c")).collect()}
    assert out[1] == ""                      # whole mention removed ('x' is too short)
    assert out[2] == "see"                   # links gone, 'and'/'ok' dropped
    assert out[3] == "nave words"            # non-ASCII letters dropped: "t", "dj" too short, "nave" kept
    assert out[4] == "" and out[5] == ""
    assert out[6] == "dont stop"             # quirk 10: 'dont' is not a stop word
    assert out[7] == "tab nbsp word"         # tab and no-break space split tokens
    bi = df.select("id", tx.bigrams(tx.whitespace_tokens("text")).alias("b")).where("id = 8").first()["b"]
    assert bi == []                          # one token → no false bigram


def test_numeric_coercion(spark):
    df = spark.createDataFrame([(" ",), ("",), ("1.5",), ("abc",), (None,)], "v string")
    vals = [r[0] for r in df.select(S.to_number("v")).collect()]
    assert vals == [None, None, 1.5, None, None]


def test_map_values_unmapped_is_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    vals = [r[0] for r in df.select(S.map_values("k", {"a": 1, "b": 2})).collect()]
    assert vals == [1, 2, None]


def _rules(spark, baskets, support=0.0, conf=0.0, max_len=3):
    pairs = spark.createDataFrame([(b, i) for b, items in baskets.items() for i in items], "b string, item string")
    pairs = B.transactions(B.basket_item_counts(pairs, ["b"], "item"), ["b"])
    sets = B.frequent_itemsets_levelwise(pairs, ["b"], support, max_len)
    return pairs, sets, B.association_rules(sets, conf)


def test_rules_confidence_one_and_threshold(spark):
    # 'x' always with 'y' → conf(x ⇒ y) = 1 → conviction inf; conf(y ⇒ x) = 2/4 = 0.5 exactly at threshold
    baskets = {"1": ["x", "y"], "2": ["x", "y", "y"], "3": ["y"], "4": ["y", "z"]}
    _, _, rules = _rules(spark, baskets, 0.0, 0.5)
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in rules.collect()}
    assert math.isinf(got[(("x",), ("y",))]["conviction"])
    assert got[(("y",), ("x",))]["confidence"] == 0.5


def test_multi_item_consequents(spark):
    baskets = {str(i): ["a", "b", "c"] for i in range(4)}
    _, sets, rules = _rules(spark, baskets)
    assert sets.count() == 7
    assert rules.where(F.size("antecedents") + F.size("consequents") == 3).count() == 6


def test_basket_size_counts_repeats_and_drops_nulls(spark):
    df = spark.createDataFrame([(1, "d", "milk"), (1, "d", "milk"), (1, "d", "cream cheese "), (None, "d", "x"),
                                (2, None, "x"), (3, "d", None), (4, "d", "bread")], "m int, d string, item string")
    lists = B.basket_lists(B.basket_item_counts(df, ["m", "d"], "item"), ["m", "d"]).collect()
    by = {r["m"]: r for r in lists}
    assert set(by) == {1, 4}
    assert by[1]["basket_size"] == 3 and by[1]["items"] == ["cream cheese ", "milk"]   # blank kept (quirk 9)


def test_levelwise_equals_fpgrowth(spark):
    baskets = {str(i): items for i, items in enumerate(
        [["a", "b"], ["a", "c"], ["a", "b", "c"], ["b", "c"], ["a", "b", "c", "d"], ["d"], ["a", "d"]])}
    pairs, lw, _ = _rules(spark, baskets, 0.2, 3)
    fp = B.frequent_itemsets_fpgrowth(pairs, ["b"], 0.2, 3)
    cmp = B.compare_itemsets(lw, fp).collect()
    assert all(r["mismatches"] == 0 and r["n_a"] == r["n_b"] for r in cmp)


def test_recommend_containment_and_not_in_basket(spark):
    baskets = {"1": ["a", "b"], "2": ["a"], "3": ["a", "b", "c"], "4": ["a", "b", "c"]}
    pairs, _, rules = _rules(spark, baskets, 0.0, 0.1)
    recs = B.recommend(pairs, ["b"], rules, 5).collect()
    got = {(r["b"], r["item"]) for r in recs}
    assert ("1", "c") in got and ("1", "a") not in got       # 'a' already in basket 1
    assert all(r["b"] != "3" and r["b"] != "4" for r in recs)  # nothing left to recommend


def test_hash_rank_is_exact_with_many_buckets(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).alias("cls"))
    fast = X.hash_rank(df, ["id"], 7, by=["cls"], purpose="x")
    w = Window.partitionBy("cls").orderBy(X.hash_key(["id"], 7, "x"), "id")
    plain = df.withColumn("_rank", F.row_number().over(w))
    assert fast.select("id", "cls", "_rank").exceptAll(plain.select("id", "cls", "_rank")).count() == 0


def test_sampling_edge_cases(spark):
    df = spark.createDataFrame([(i, "big" if i < 13 else ("one" if i == 13 else "mid")) for i in range(20)],
                               "id int, label string")
    under = X.undersample(df, "label", ["id"]).groupBy("label").count().collect()
    assert {r["count"] for r in under} == {1}
    split = X.stratified_split(df, "label", ["id"], 0.2)
    assert split.where("split = 'test'").count() == math.ceil(0.2 * 20)
    folds = X.kfold(df, "label", ["id"], 5).groupBy("fold").count().collect()
    assert sum(r["count"] for r in folds) == 20
    empty = spark.createDataFrame([], "id int, label string")
    assert X.undersample(empty, "label", ["id"]).count() == 0


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "label int, prediction int")
    rep = {r["class"]: r for r in V.class_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0   # never predicted → 0, not NaN
    assert rep["accuracy"]["f1"] == 0.75
    cm = V.confusion(df).collect()
    assert len(cm) == 9 and sum(r["count"] for r in cm) == 4
    same = spark.createDataFrame([(0, 5), (0, 5), (1, 7)], "a int, b int")
    assert V.adjusted_rand_index(same, "a", "b").first()["ari"] == 1.0


def test_silhouette_single_member_cluster(spark):
    pts = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [5.0, 5.0], 1)],
                                "id long, v array<double>, c long")
    s = {r["id"]: r["s"] for r in N.silhouette(pts, "id", "v", "c").collect()}
    assert s[3] == 0.0
    a, b = 1.0, (math.dist([0, 0], [5, 5]))
    assert abs(s[1] - (b - a) / b) < 1e-12


def test_null_audit_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, None)], "x double, s string")
    clean, report = P.drop_missing_report(df)
    r = {row["column"]: row for row in report.collect()}
    assert r["x"]["nulls"] == 2 and r["s"]["nulls"] == 1 and r["x"]["rows_after"] == 1
    assert clean.count() == 1


def test_names_normalise(spark):
    df = spark.createDataFrame([("Mr. Mime",), ("ho-oh",)], "n string")
    assert [r[0] for r in df.select(tx.normalize_key("n")).collect()] == ["mr__mime", "ho_oh"]
    paths = spark.createDataFrame([("imgs/Ho_Oh.PNG",), ("a/b.c/mr-mime.png",)], "p string")
    assert [r[0] for r in paths.select(tx.file_stem("p")).collect()] == ["ho_oh", "mr-mime"]


def test_porter_examples(spark):
    from quarry.functions.stem import stem_column

    # worked examples from the published algorithm
    cases = {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre",
             "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat",
             "hopping": "hop", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
             "conditional": "condit", "digitizer": "digit", "operator": "oper", "hopefulness": "hope",
             "formaliti": "formal", "triplicate": "triplic", "goodness": "good", "revival": "reviv",
             "adjustment": "adjust", "adoption": "adopt", "probate": "probat", "rate": "rate",
             "controll": "control", "generalizations": "gener", "oscillators": "oscil", "at": "at"}
    df = spark.createDataFrame([(k,) for k in cases], "token string")
    got = {r["token"]: r["stem"] for r in stem_column(df, "token").collect()}
    assert got == cases


def test_stem_tokens_shuffles_documents_not_tokens(spark):
    from quarry.operators.text import stem_tokens

    df = spark.createDataFrame([(1, ["running", None, "dogs"]), (2, None)], "d long, t array<string>")
    out = stem_tokens(df, "d", F.col("t"))
    assert {r["d"]: r["stems"] for r in out.collect()} == {1: ["run", "dog"], 2: []}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    whole = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert whole.count("Exchange hashpartitioning") == 1             # of documents, before their tokens are rows


def test_stem_tokens_keeps_order_and_empty_docs(spark):
    from quarry.operators.text import stem_tokens

    df = spark.createDataFrame([(1, ["ponies", "cats", "ponies"]), (2, [])], "d long, t array<string>")
    got = {r["d"]: r["stems"] for r in stem_tokens(df, "d", F.col("t")).collect()}
    assert got == {1: ["poni", "cat", "poni"], 2: []}


def test_sources_missing_path_charset_and_append(spark):
    import os
    import tempfile

    import pytest

    from quarry.sources import files as io

    base = tempfile.mkdtemp(prefix="quarry-io-")
    with pytest.raises(io.SourceNotFound):
        io.read_csv(spark, os.path.join(base, "nope.csv"))
    df = spark.createDataFrame([(1, "café"), (2, "naïve")], "id int, w string")
    io.write_csv(df, os.path.join(base, "l1"), encoding="latin-1")
    back = io.read_csv(spark, os.path.join(base, "l1"), schema="id int, w string", encoding="latin-1")
    assert sorted(r["w"] for r in back.collect()) == ["café", "naïve"]
    coll = os.path.join(base, "coll")
    assert io.replace_collection(df, coll) == 2
    assert io.append_collection(df, coll) == 2                      # re-running appends duplicates
    assert io.read_collection(spark, coll, "id int, w string").count() == 4
    assert io.replace_collection(df, coll) == 2
    assert io.read_collection(spark, coll, "id int, w string").count() == 2


def test_blocked_pairs_equal_single_block(spark, small_dir):
    from quarry.operators import encode as E

    e = spark.read.parquet(f"{small_dir}/embeddings.parquet").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    z = E.fit_array_scaler(e, "embedding").transform(e)
    q, b = z.where(F.col("vec_id") % 5 == 0), z.where(F.col("vec_id") % 5 != 0)
    one = N.knn_candidates(q, b, "vec_id", "vec_id", "features", "label", 5, block_rows=100_000)
    many = N.knn_candidates(q, b, "vec_id", "vec_id", "features", "label", 5, block_rows=7)
    assert one.count() == many.count() > 0
    assert one.exceptAll(many).count() == 0
    s1 = N.silhouette(z, "vec_id", "features", "label", block_rows=100_000).select("vec_id", F.round("s", 9))
    s2 = N.silhouette(z, "vec_id", "features", "label", block_rows=9).select("vec_id", F.round("s", 9))
    assert s1.exceptAll(s2).count() == 0


def test_words_and_pairs_make_the_vocabulary_of_all_bigrams(spark):
    """Pairs of rare words are not made, and the vocabulary is still that of all pairs, ties included."""
    import random
    from quarry.functions import text as tx
    from quarry.operators import text as T

    rng = random.Random(8)
    rows = [(i, [f"w{min(int(rng.expovariate(0.12)), 60)}" for _ in range(rng.randint(0, 30))]) for i in range(120)] + [(999, None)]
    df = spark.createDataFrame(rows, "d int, t array<string>")
    told = lambda docs, n: [tuple(r) for r in T.vocabulary(T.term_counts(docs, "d", F.col("g")), "d", n).collect()]
    every = tx.with_bigrams("t")
    for n in (1, 12, 40, 10**6):
        words = T.frequent_words(df, F.col("t"), n)
        assert words is None if n == 10**6 else len(words) >= n
        made = T.words_and_pairs(df, "t", words, "g")
        assert told(made, n) == told(df.withColumn("g", every), n)
        if n == 12:
            assert made.select(F.explode("g").alias("g")).distinct().count() < 0.7 * df.select(F.explode(every).alias("g")).distinct().count()


def test_stems_are_mapped_without_a_shuffle_of_tokens(spark):
    """Tokens stay in blocks; a block's words go to the stemmer once."""
    from quarry.operators.text import stem_tokens

    rows = [(i, ["running", None, "flies"] * 50 if i % 3 else ([] if i % 2 else None), f"c{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "d int, t array<string>, c string").coalesce(1)
    out = stem_tokens(df, "d", F.col("t"), ["c"])
    assert [f.name for f in out.schema.fields] == ["d", "c", "stems"]
    assert {r["d"]: (r["c"], r["stems"]) for r in out.collect()} == {
        i: (f"c{i}", ["run", "fli"] * 50 if i % 3 else []) for i in range(40)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(words" in plan and "posexplode(_tok" not in plan
