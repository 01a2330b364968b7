"""Exact operators against brute force: nearest neighbours, trees, support vectors, itemsets, quantiles, clusters."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quarry.operators import baskets as B
from quarry.operators import encode as E
from quarry.operators import fptree, lloyd, network, pca, profile, quantiles, svm, tree, voronoi
from quarry.operators import models as M
from quarry.operators import neighbours as N
from quarry.operators import sampling as X
from quarry.session import right_size

# ---------------------------------------------------------------------------------------------------------
# nearest neighbours


def brute_nearest(q, b, k):
    d = np.round(voronoi.distances(q, b), voronoi.DIGITS)
    return [np.lexsort((np.arange(len(b)), row))[:k].tolist() for row in d]


@pytest.mark.parametrize("kind", ["grid", "copies"])
def test_neighbours_equal_all_pairs(spark, kind):
    rng = np.random.default_rng(1)
    if kind == "grid":       # many ties
        base, query = rng.integers(0, 4, (150, 3)).astype(float), rng.integers(0, 4, (40, 3)).astype(float)
    else:                    # a third of the base is one row, and queries far away
        base = np.vstack([np.zeros((60, 2)), rng.normal(size=(120, 2)) * 5])
        query = np.vstack([base[50:70], [[1e6, 0], [0, -1e6]]])
    b = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(base)], "bk long, bv array<double>, lab long")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(query)], "qk long, qv array<double>")
    found, work = voronoi.nearest(q, b, 4, block_rows=20, pivots=8, rings=3)
    got = {}
    for r in found.collect():
        assert r["lab"] == r["bk"] % 3
        got.setdefault(r["qk"], {})[r["rank"]] = r["bk"]
    assert [[got[i][k] for k in range(1, 5)] for i in range(len(query))] == brute_nearest(query, base, 4)
    assert work.first()["compared"] <= work.first()["pairs"] == len(base) * len(query)


def test_neighbours_of_few_or_no_rows(spark):
    b = spark.createDataFrame([(1, [0.0], 5), (2, [1.0], 6)], "k long, v array<double>, lab long")
    q = spark.createDataFrame([(7, [0.9]), (8, None)], "k long, v array<double>")
    got = N.knn_candidates(q, b, "k", "k", "v", "lab", 5).collect()
    assert sorted((r["k"], r["neighbour"], r["rank"]) for r in got) == [(7, 1, 2), (7, 2, 1)]
    assert N.knn_candidates(q, b.limit(0), "k", "k", "v", "lab", 5).count() == 0
    assert N.knn_candidates(q.limit(0), b, "k", "k", "v", "lab", 5).count() == 0


def test_bounds_leave_out_more_of_a_larger_base(spark):
    rng = np.random.default_rng(0)
    centres, share = rng.normal(size=(20, 4)) * 10, []
    for n in (500, 4000):
        x = centres[rng.integers(0, 20, n)] + rng.normal(size=(n, 4))
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "bk long, bv array<double>, lab long")
        q = df.where("bk % 20 = 0").select(F.col("bk").alias("qk"), F.col("bv").alias("qv"))
        w = voronoi.nearest(q, df, 3, block_rows=100)[1].first()
        share.append(w["compared"] / w["pairs"])
    assert share[1] < share[0] < 0.5


# ---------------------------------------------------------------------------------------------------------
# trees


def brute_tree(x, y, classes, depth=0):
    counts = np.bincount(y, minlength=classes)
    best = None
    for f in range(x.shape[1]) if np.count_nonzero(counts) > 1 else ():
        values = np.unique(x[:, f])
        for a, b in itertools.pairwise(values):
            t = float(tree.middle(a, b))
            low = np.bincount(y[x[:, f] <= t], minlength=classes).astype(float)
            score = float(tree.rate(low, counts.astype(float)))
            if best is None or score > best[0]:
                best = score, f, t
    node = [(depth, tuple(counts), best and best[1], best and best[2])]
    if best is None:
        return node
    left = x[:, best[1]] <= best[2]
    return node + brute_tree(x[left], y[left], classes, depth + 1) + brute_tree(x[~left], y[~left], classes, depth + 1)


def in_order(nodes, at=0):
    n = nodes[at]
    out = [(n["depth"], tuple(n["counts"]), n["feature"], n["threshold"])]
    return out if n["left"] is None else out + in_order(nodes, n["left"]) + in_order(nodes, n["right"])


@pytest.mark.parametrize("cells", [10**6, 120])
def test_tree_equals_a_loop_with_ties(spark, cells):
    rng = np.random.default_rng(cells)
    x, y = rng.integers(0, 5, (120, 3)).astype(float), rng.integers(0, 3, 120)
    df = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"])
    model = tree.fit(df, local_cells=cells)      # with few cells the first levels are split over the cluster
    nodes = {r["id"]: r.asDict() for r in model.nodes.collect()}
    assert in_order(nodes) == brute_tree(x, y, 3)
    a = sorted((tuple(r["features"]), r["prediction"]) for r in model.transform(df).collect())
    if cells == 10**6:
        model.held = 1                           # walked by joins
        assert sorted((tuple(r["features"]), r["prediction"]) for r in model.transform(df).collect()) == a
    top = M.tree_nodes(model, 1).collect()
    assert sorted(r["depth"] for r in top) == [0, 1, 1]


def test_tree_is_deeper_than_thirty():
    x = np.arange(80.0)[:, None]
    y = np.array([1 if bin(i).count("1") % 2 else 0 for i in range(80)])
    chain = np.where(np.arange(80) % 2, 1, 0)
    weights = np.repeat(np.arange(80), 1 + np.arange(80) ** 2 // 40)      # large ends split off one by one
    nodes = tree.grow(weights[:, None].astype(float), chain[weights], 2, 0, 0)
    assert max(n["depth"] for n in nodes) > 30 and all(max(n["counts"]) == n["n"] for n in nodes if n["feature"] is None)
    assert sum(n["n"] for n in tree.grow(x, y, 2, 0, 0) if n["feature"] is None) == 80


def test_tree_of_rows_that_agree(spark):
    df = spark.createDataFrame([(float(i % 3 == 0), Vectors.dense([1.0, 2.0])) for i in range(50)], ["label", "features"])
    for cells in (10**6, 10):
        nodes = tree.fit(df, local_cells=cells).nodes.collect()
        assert len(nodes) == 1 and list(nodes[0]["counts"]) == [33, 17] and nodes[0]["prediction"] == 0


# ---------------------------------------------------------------------------------------------------------
# squared hinge


def newton(a, y, c):
    w = np.zeros(a.shape[1])

    def value(w):
        return 0.5 * w @ w + c * (np.maximum(0, 1 - y * (a @ w)) ** 2).sum()

    for _ in range(100):
        on = y * (a @ w) < 1
        g = w - 2 * c * a[on].T @ (y[on] - a[on] @ w)
        d = np.linalg.solve(np.eye(len(w)) + 2 * c * a[on].T @ a[on], -g)
        t = 1.0
        while value(w + t * d) > value(w) + 1e-4 * t * (g @ d) and t > 1e-12:
            t /= 2
        w = w + t * d
    return w, value


@pytest.mark.parametrize("held", [1 << 26, 0])
def test_squared_hinge_reaches_the_least_objective(spark, monkeypatch, held):
    monkeypatch.setattr(svm, "HELD_BYTES", held)     # one task, or the cluster
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    x[rng.random(x.shape) < 0.4] = 0
    y = (x @ rng.normal(size=(5, 3)) + rng.normal(size=(200, 3))).argmax(1)
    rows = [(float(k), Vectors.dense(v) if i % 2 else Vectors.sparse(5, [(int(j), float(v[j])) for j in np.flatnonzero(v)]))
            for i, (v, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["label", "features"])
    model = svm.fit(df, C=0.7)
    a = np.column_stack([x, np.ones(len(x))])
    for k in range(3):
        w, value = newton(a, np.where(y == k, 1.0, -1.0), 0.7)
        assert value(model.weights[k]) - value(w) < 1e-6
    got = model.transform(df).collect()
    assert [r["prediction"] for r in got] == (a @ model.weights.T).argmax(1).tolist()
    assert svm.fit(df.limit(0)).weights.shape == (1, 1)


# ---------------------------------------------------------------------------------------------------------
# itemsets


@pytest.mark.parametrize("longest,rows", [(None, 10**6), (3, 10**6), (3, 2), (2, 1), (1, 1)])
def test_capped_trees_equal_counting(spark, monkeypatch, longest, rows):
    rng = np.random.default_rng(5)
    baskets = [sorted(set(rng.integers(0, 7, rng.integers(0, 6)).tolist())) for _ in range(60)]
    df = spark.createDataFrame([(b,) for b in baskets] + [(None,)], "items array<int>")
    want = {s: n for m in range(1, (longest or 7) + 1) for s in itertools.combinations(range(7), m)
            if (n := sum(set(s) <= set(b) for b in baskets)) >= 4}
    got = fptree.mine(df, 4, longest, rows).collect()
    assert {tuple(r["items"]): r["freq"] for r in got} == want and len(got) == len(want)


def test_no_set_longer_than_the_cap_is_built():
    seen = []
    rows = [(list(range(12)), 5)]
    for s, _ in fptree.grow(rows, 1, 2):
        seen.append(len(s))
    assert max(seen) == 2 and len(seen) == 12 + math.comb(12, 2)


# ---------------------------------------------------------------------------------------------------------
# quantiles


@pytest.mark.parametrize("values", [
    [1.0], [2.0, 2.0, 2.0], [1e300, -1e300, 0.0, 5e-324], [float("inf"), 1.0, float("-inf"), 2.0],
    np.random.default_rng(1).normal(size=700).tolist(), [1.0] * 300 + [2.0, 1e9], list(range(101))])
def test_quantiles_equal_pandas(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    shares = [0, 0.25, 0.5, 0.9, 1]
    finite = [v for v in values if math.isfinite(v)]
    got = quantiles.quantiles(df, "x", shares)
    if len(finite) == len(values):
        assert got == pytest.approx(pd.Series(values).quantile(shares).tolist(), rel=1e-12)
    assert quantiles.at_ranks(df, "x", range(len(values))) == dict(enumerate(sorted(values)))


def test_described_columns(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,), (10,)], "x int")
    r = profile.describe(df, "x").first()
    want = pd.Series([3, 1, 2, 10]).describe()
    assert [r[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(want.tolist())
    assert profile.describe(df.limit(0), "x").first()["p50"] is None


def test_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("day"), (F.col("id") * 37 % 6000).alias("x"))
    parts = df.groupBy("day").agg(quantiles.distinct_sketch("x").alias("d"), quantiles.quantile_sketch("x").alias("q"))
    n = parts.agg(quantiles.merged_distinct("d").alias("n")).first()["n"]
    assert abs(n / 6000 - 1) < 0.04
    exact = quantiles.quantiles(df, "x", [0.1, 0.5, 0.9])
    for r, e in zip(quantiles.merged_quantiles(parts, "q", [0.1, 0.5, 0.9]).orderBy("share").collect(), exact):
        assert abs(r["value"] - e) < 0.01 * 6000


# ---------------------------------------------------------------------------------------------------------
# clusters


def test_curve_never_rises_and_centres_are_means(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 0.5, (60, 2)) for c in ((0, 0), (5, 5), (0, 9))])
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>")
    curve = lloyd.curve(df, "v", range(1, 8))
    errors = [curve[k][0] for k in range(1, 8)]
    assert all(b <= a for a, b in itertools.pairwise(errors)) and errors[2] < 0.1 * errors[1]
    assert errors[0] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    for k, (error, centres) in curve.items():
        d = ((x[:, None] - centres[None]) ** 2).sum(2)
        assert error == pytest.approx(d.min(1).sum()) and len(centres) == k
    assert lloyd.curve(df.limit(0), "v", [1, 2]) == {}
    same = spark.createDataFrame([([1.0],)] * 5, "v array<double>")
    assert [len(c) for _, c in lloyd.curve(same, "v", [1, 3]).values()] == [1, 1]


@pytest.mark.parametrize("block", [1, 1024])
def test_linear_silhouette_equals_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(60, 3)), rng.integers(0, 4, 60)
    c[7] = 9                     # alone in its cluster
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, c))], "i long, v array<double>, c int")
    got = {r["i"]: r["s"] for r in N.silhouette_squared(df, "i", "v", "c", block).collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    for i in range(60):
        mine = (c == c[i]) & (np.arange(60) != i)
        b = min(d[i, c == k].mean() for k in set(c.tolist()) - {c[i]})
        want = 0.0 if not mine.any() else (b - d[i, mine].mean()) / max(b, d[i, mine].mean())
        assert got[i] == pytest.approx(want, abs=1e-9)


def _all_pairs_silhouette(x, c):
    """``a``, ``b``, ``s`` of every row, by differences."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(len(x)):
        mine = (c == c[i]) & (np.arange(len(x)) != i)
        a = d[i, mine].mean() if mine.any() else None
        b = min(d[i, c == k].mean() for k in set(c.tolist()) - {c[i]})
        yield a, b, 0.0 if a is None or not max(a, b) else (b - a) / max(a, b)


@pytest.mark.parametrize("block", [7, 64, 100_000])
def test_exact_silhouette_by_blocks_of_clusters(spark, block):
    rng = np.random.default_rng(5)
    c = np.concatenate([np.zeros(40, int), np.ones(25, int), np.arange(60) % 20 + 2, [99]])   # cut, whole and single
    x = rng.normal(size=(len(c), 3)) + 1e4 + c[:, None] % 3
    x[1], x[50], x[60:63] = x[0], x[51] + 1e-7, x[0]       # equal and nearly equal rows, also of other clusters
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, c))]
    rows += [(900, [1e4, 1e4, 1e4], None), (901, None, 0)]
    df = spark.createDataFrame(rows, "i long, v array<double>, c int")
    got = {r["i"]: r for r in N.silhouette(df, "i", "v", "c", block).collect()}
    assert len(got) == len(x) + 1 and 901 not in got
    assert (got[900]["c"], got[900]["a"], got[900]["b"], got[900]["s"]) == (None, None, None, 0.0)
    for i, want in enumerate(_all_pairs_silhouette(x, c)):
        assert got[i]["c"] == c[i]
        for name, value in zip("abs", want):
            assert got[i][name] is None if value is None else got[i][name] == pytest.approx(value, rel=1e-10, abs=1e-12)


def test_exact_silhouette_of_equal_rows_is_zero(spark):
    df = spark.createDataFrame([(i, [0.1, 0.7], i % 2) for i in range(6)], "i long, v array<double>, c int")
    assert [(r["a"], r["b"], r["s"]) for r in N.silhouette(df, "i", "v", "c").collect()] == [(0.0, 0.0, 0.0)] * 6


def test_exact_silhouette_takes_each_distance_once_and_sends_one_row_a_block(monkeypatch):
    rng = np.random.default_rng(6)
    taken, tiles = [], N._tiles
    monkeypatch.setattr(N, "_tiles", lambda q, b: (taken.append(d.size) or (at, d) for at, d in tiles(q, b)))

    def block(first, n, clusters, cut=False):
        return pd.DataFrame({"qk": np.arange(first, first + n), "c": np.arange(first, first + n) // (n // clusters),
                             "v": list(rng.normal(size=(n, 4))), "cut": cut, "i": 0, "j": 1})

    left, right = block(0, 600, 200), block(600, 900, 300)
    sent = N._meet(left, right)
    assert sum(taken) == 600 * 900                         # one distance serves both rows
    assert len(sent) == sent["qk"].nunique() == 1500       # not a row for each of 500 clusters
    d = np.sqrt(((np.stack(left["v"])[:, None] - np.stack(right["v"])[None]) ** 2).sum(2))
    least = sent.set_index("qk")["least"]
    assert np.allclose(least[np.arange(600)], d.reshape(600, 300, 3).mean(2).min(1), rtol=1e-12)
    assert np.allclose(least[np.arange(600, 1500)], d.reshape(200, 3, 900).mean(1).min(0), rtol=1e-12)


def test_exact_silhouette_sends_rows_to_few_blocks(spark):
    p = spark.range(4000).select(F.col("id").alias("qk"), F.array(F.col("id").cast("double")).alias("v"),
                                 F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 800 + 1).cast("int").alias("c"))
    dealt, blocks = N._dealt(p, 4000, 500)
    sizes = {r["block"]: r["count"] for r in dealt.groupBy("block").count().collect()}
    assert sum(sizes.values()) == 4000 and max(sizes) < blocks <= 8 and max(sizes.values()) < 1000
    assert dealt.groupBy("c").agg(F.countDistinct("block").alias("b"), F.max("cut").alias("cut")).where(
        "cut != (c = 0) or (b > 1) != cut").count() == 0


def test_folds_are_scored_one_after_the_other(spark):
    rows = [(float(i % 2), Vectors.dense([float(i % 2), float(i % 5)]), i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, ["label", "features", "fold"])
    for _ in range(3):
        assert M.cross_validate(df, M.linear_svm_ovr, k=3) == [(0, 1.0), (1, 1.0), (2, 1.0)]


def test_itemsets_of_names(spark):
    rows = [(b, i) for b, items in enumerate(["abc", "ab", "ac", "b", "abcd"]) for i in items]
    pairs = spark.createDataFrame(rows, "b int, item string")
    got = {tuple(r["items"]): (r["freq"], r["size"]) for r in B.frequent_itemsets_fpgrowth(pairs, ["b"], 0.5, 2).collect()}
    assert got == {("a",): (4, 1), ("b",): (4, 1), ("c",): (3, 1), ("a", "b"): (3, 2), ("a", "c"): (3, 2)}
    assert X.kfold(pairs, "item", ["b", "item"], 2).count() == len(rows)


# ---------------------------------------------------------------------------------------------------------
# principal components


@pytest.mark.parametrize("whole", [512, 4])
def test_components_equal_eigenvectors(spark, monkeypatch, whole):
    monkeypatch.setattr(pca, "WHOLE", whole)
    monkeypatch.setattr(pca, "MORE", 4)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 9)) * np.linspace(4, 0.3, 9) + 7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, v array<double>")
    got = np.array([r["pca"] for r in E.pca_2d(df, "v").orderBy("i").collect()])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    want = vectors[:, ::-1][:, :2]
    want = want * np.sign(want[np.abs(want).argmax(0), [0, 1]])
    assert np.allclose(got, (x - x.mean(0)) @ want, atol=1e-5)


def test_components_of_a_wide_sparse_table(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        at = sorted({*rng.integers(0, 100_000, 5).tolist(), 17 + 1000 * (i % 2)})
        rows.append((i, Vectors.sparse(100_000, [(j, 20.0 if j in (17, 1017) else 1.0) for j in at])))
    df = spark.createDataFrame(rows, ["i", "v"])
    mean, found = pca.directions(df, "v", 1, rounds=30)
    assert len(mean) == 100_000 and set(np.argsort(-np.abs(found[0]))[:2]) == {17, 1017}
    side = {r["i"] % 2: [] for r in df.select("i").collect()}
    for r in pca.project(df, "v", mean, found).collect():
        side[r["i"] % 2].append(r["pca"][0])
    assert max(side[0]) < min(side[1]) or max(side[1]) < min(side[0])


# ---------------------------------------------------------------------------------------------------------
# rows that take part in a product


def test_products_take_only_rows_that_fall_short():
    rng = np.random.default_rng(2)
    dense = rng.normal(size=(40, 6)) * (rng.random((40, 6)) < 0.5)
    dense[3] = 0
    n = (dense != 0).sum(1)
    r = svm.Rows(np.concatenate([[0], np.cumsum(n)]), np.nonzero(dense)[1].astype(np.int32), dense[dense != 0],
                 rng.integers(0, 3, 40).astype(np.int32))
    w, v, x = rng.normal(size=(7, 3)), rng.normal(size=(7, 3)), np.c_[dense, np.ones(40)]
    short = svm._short(r, np.arange(3), w)[1]
    active = [r.where(s > 0) for s in short.T]
    assert [len(a.label) for a in active] == (short > 0).sum(0).tolist() and any(len(a.label) < 40 for a in active)
    want = x.T @ (2 * (short > 0) * (x @ v))
    assert np.allclose(svm._bent(active, v, 7)[:-3].reshape(3, 7).T, want)
    held = svm.Held([r, r], 7, 1.0, 0)
    for _ in range(2):                               # the second time from what is held
        assert np.allclose(held._sum(np.arange(3), w, v)[1].T, 2 * want)


@pytest.mark.parametrize("near", [0.0, 1.0])
def test_products_read_only_rows_that_fall_short(spark, monkeypatch, near):
    """Over the cluster, rows that fall short are kept apart for the products of a step, and given back after it."""
    monkeypatch.setattr(svm, "HELD_BYTES", 0)
    monkeypatch.setattr(svm, "NEAR", near)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) + 4 * np.eye(4)[rng.integers(0, 3, 300)]
    y = x[:, :3].argmax(1)
    df = spark.createDataFrame([(float(k), Vectors.dense(v)) for v, k in zip(x, y)], ["label", "features"]).repartition(3)
    kept, rows_near = [], svm.Loss._rows_near

    def watched(self, which, w):
        found = rows_near(self, which, w)
        if found is not None and (not kept or kept[-1][0] is not found):
            kept.append((found, sum(len(np.frombuffer(r["label"], np.int32)) for r in found.collect())))
        return found

    monkeypatch.setattr(svm.Loss, "_rows_near", watched)
    model = svm.fit(df, C=0.7)
    a = np.column_stack([x, np.ones(len(x))])
    for k in range(3):
        w, value = newton(a, np.where(y == k, 1.0, -1.0), 0.7)
        assert value(model.weights[k]) - value(w) < 1e-6
    assert bool(kept) == (near > 0)
    assert all(n == 300 for _, n in kept[:1]) and (not kept or kept[-1][1] < 200)
    assert not any(f.storageLevel.useMemory for f, _ in kept)


def test_a_fit_keeps_its_cores(spark):
    rows = spark.range(0, 60_000, 1, 12)
    assert right_size(rows, 60_000).rdd.getNumPartitions() == 12
    assert right_size(rows, 6_000).rdd.getNumPartitions() == 2


# ---------------------------------------------------------------------------------------------------------
# trees over the cluster


def test_few_coarse_bins_give_the_tree_of_one_task(spark, monkeypatch):
    """Only bins that can hold the best threshold are counted by their values, and where bins end never shows."""
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(600, 3)) * [1, 5, 0.4], 1)
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(int) + (x[:, 1] > 6)
    df = spark.createDataFrame([(Vectors.dense(v), int(k)) for v, k in zip(x, y)], ["features", "label"])
    told = lambda t: sorted((r["depth"], r["n"], r["feature"], r["threshold"], r["counts"]) if r["feature"] is not None
                            else (r["depth"], r["n"], -1, 0.0, r["counts"]) for r in t.nodes.collect())
    want = told(tree.fit(df))
    monkeypatch.setattr(tree, "STORE_LEVELS", 3)
    for bins, corners in ((1024, 8), (20, 8), (20, 1)):
        monkeypatch.setattr(tree, "BINS", bins)
        monkeypatch.setattr(tree, "CORNER_CLASSES", corners)
        assert told(tree.fit(df, local_cells=600)) == want


def test_a_task_splits_all_nodes_of_a_depth_together(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.c_[rng.integers(0, 3, 900), rng.normal(size=900), rng.integers(0, 40, 900)]
    y = rng.integers(0, 3, 900)
    calls, middle = [], tree.middle
    for counted in (1, 16, 10**6):               # of a sorted or a counted feature, the same tree
        monkeypatch.setattr(tree, "COUNTED", counted)
        monkeypatch.setattr(tree, "middle", lambda a, b: calls.append(1) or middle(a, b))
        nodes = tree.grow(x, y, 3, 5, 0)
        made = len(calls)
        calls.clear()
        monkeypatch.setattr(tree, "middle", middle)
        assert in_order({n["id"]: n for n in nodes}, 5) == brute_tree(x, y, 3)
        assert made <= 3 * (1 + max(n["depth"] for n in nodes)) < sum(n["feature"] is not None for n in nodes)


@pytest.mark.parametrize("cells", [10**6, 60])
def test_a_tree_that_is_not_held_scores_part_by_part(spark, monkeypatch, cells):
    values = np.repeat(np.arange(60.0), 1 + np.arange(60) ** 2 // 80)     # large ends split off one by one: deep
    df = spark.createDataFrame([(i, float(v) % 2, Vectors.dense([v])) for i, v in enumerate(values)] + [(-1, 0.0, None)], ["i", "label", "features"])
    model = tree.fit(df, local_cells=cells)
    assert model.nodes.agg(F.max("depth")).first()[0] > 15
    want = sorted((r["i"], r["prediction"]) for r in model.transform(df).where("i >= 0").collect())
    model.held, written, stored = 1, [], tree.stored
    monkeypatch.setattr(tree, "PART_ROWS", 100)
    monkeypatch.setattr(tree, "stored", lambda d, name: written.append(name) or stored(d, name))
    out = model.transform(df)
    assert sorted((r["i"], r["prediction"]) for r in out.where("i >= 0").collect()) == want
    assert out.where("i < 0").first()["prediction"] is None and out.columns == [*df.columns, "prediction"]
    assert len(written) <= 3                     # not some for every level


# ---------------------------------------------------------------------------------------------------------
# fused network


def test_gradient_of_the_network():
    rng = np.random.default_rng(0)
    net = network.Net([3, 4], [network.Block("a", 5), network.Block("b", 2)], 6, 0.0, 3)
    w = net.start(1) + 0.1 * rng.normal(size=net.size)
    x, y = [rng.normal(size=(7, 3)), rng.normal(size=(7, 4))], rng.integers(0, 3, 7)
    _, g = net.gradient(w, x, y)
    for i in rng.integers(0, net.size, 25):
        e = np.zeros(net.size)
        e[i] = 1e-6
        assert (net.gradient(w + e, x, y)[0] - net.gradient(w - e, x, y)[0]) / 2e-6 == pytest.approx(g[i], abs=1e-5)


def test_network_learns_repeats_and_stops_early(spark):
    rng = np.random.default_rng(3)
    x, noise = rng.normal(size=(240, 4)), rng.normal(size=(240, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)          # not linear
    rows = [(i, float(k), Vectors.dense(v), Vectors.dense(z)) for i, (k, v, z) in enumerate(zip(y, x, noise))]
    df = spark.createDataFrame(rows, ["i", "label", "a", "b"])
    train, held = df.where("i % 4 > 0"), df.where("i % 4 = 0")
    blocks = [network.Block("a", 32, 0.1), network.Block("b", 4, 0.5)]
    fit = lambda **k: network.fit(train, held, blocks, "i", joint=16, joint_dropout=0.1, rate=0.02, batch=16, **k)
    model = fit(epochs=14, patience=4)
    assert len(model.history) < 14 or model.history[-1]["loss"] < model.history[0]["loss"]
    least = min(h["valid_loss"] for h in model.history)
    scored = model.transform(held).collect()
    loss = -np.mean([math.log(r["probability"][int(r["label"])]) for r in scored])
    assert loss == pytest.approx(least, rel=1e-6)    # the best epoch's weights were kept
    assert np.mean([r["prediction"] == r["label"] for r in scored]) > 0.75
    once, again = fit(epochs=1), fit(epochs=1)
    assert np.allclose(once.weights, again.weights, atol=1e-6)
    stopped = network.fit(train, held, blocks, "i", joint=16, rate=0.0, epochs=9, patience=2)
    assert len(stopped.history) == 3                 # nothing falls after the first epoch


def test_network_trains_side_by_side_and_in_rounds(spark, monkeypatch):
    """Tasks do not meet within a round, and each row takes part once an epoch, in whatever task and round."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3))
    rows = [(i, float(v[0] + v[1] > 0), Vectors.dense(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, ["i", "label", "a"])
    blocks = [network.Block("a", 8)]
    fit = lambda **k: network.fit(df, df, blocks, "i", joint=8, joint_dropout=0.0, batch=16, **k)
    monkeypatch.setattr(network, "STEPS", 4)
    monkeypatch.setattr(network, "ROUND", 3)
    still = fit(rate=0.0, epochs=1).history[0]
    assert still["loss"] == pytest.approx(still["valid_loss"], rel=1e-9)      # every row once
    once, again = fit(rate=0.01, epochs=2), fit(rate=0.01, epochs=2)
    assert np.array_equal(once.weights, again.weights)
    assert fit(rate=0.02, epochs=8).history[-1]["valid_accuracy"] > 0.9


def test_epochs_do_not_shuffle_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, float(v[0] > 0), Vectors.dense(v)) for i, v in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, ["i", "label", "a"])
    monkeypatch.setattr(network, "STEPS", 4)
    dealt, repartition = [], type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, *a: dealt.append(a) or repartition(self, *a))
    history = network.fit(df, df, [network.Block("a", 4)], "i", joint=4, epochs=4, patience=9).history
    assert len(history) == 4 and len(dealt) == 1


def test_rules_of_too_large_sets_are_an_error(spark):
    big = [chr(97 + i) for i in range(21)]
    sets = spark.createDataFrame([(big, 0.5), (["a"], 0.5), (["b"], 0.5), (["a", "b"], 0.5)], "items array<string>, support double")
    assert B.association_rules(sets.where(F.size("items") < 3), 0.1).count() == 2
    with pytest.raises(Exception, match="more than 20 items"):
        B.association_rules(sets, 0.1).collect()


def test_levels_past_three(spark):
    rows = [(b, i) for b, items in enumerate(["abcde", "abcde", "abcd", "ab"]) for i in items]
    pairs = spark.createDataFrame(rows, "b int, item string")
    level, grown = (f(pairs, ["b"], 0.5).select("items", "freq") for f in (B.frequent_itemsets_levelwise, B.frequent_itemsets_fpgrowth))
    assert level.count() == 31 and level.exceptAll(grown).count() == 0 and grown.exceptAll(level).count() == 0
