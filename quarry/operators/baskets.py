"""Market-basket mining as DataFrame jobs.

Data model: a basket is identified by its key columns (e.g. member and day); its content is the long
table of distinct ``(basket keys..., item)`` pairs. Itemsets are **sorted** ``array<string>`` so that equal
sets compare equal and can be join and group keys.

Scale notes
- Nothing is collected per basket without first de-duplicating items, so a basket row is bounded by the
  item vocabulary even when one basket holds a third of all purchase lines.
- Level-wise counting holds one row per basket with its sorted frequent items. A level's candidates are made inside
  that row, from the basket's frequent sets of the level before, and go straight into a partial aggregate: one shuffle
  per level, of counts, and no candidate is written anywhere.
- Itemset, rule and category tables that are joined to baskets are stored first, so Spark knows their size in bytes and
  broadcasts them or not by its own threshold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import fptree
from quarry.session import cut_lineage, stored

ITEMS = "items"
MOST_ITEMS = 20              # of a set whose rules are enumerated


# ---------------------------------------------------------------------------------------------------------
# baskets


def basket_item_counts(df: DataFrame, basket_cols: Sequence[str], item_col: str) -> DataFrame:
    """``(basket..., item, n)``: purchase lines per basket and item; rows with a null key or item dropped.

    This is the pre-aggregation every later step starts from (map-side combine before the shuffle).
    """
    keys = list(basket_cols)
    clean = df.select(*keys, F.col(item_col).alias("item")).na.drop(subset=keys + ["item"])
    return clean.groupBy(*keys, "item").agg(F.count(F.lit(1)).alias("n"))


def basket_lists(item_counts: DataFrame, basket_cols: Sequence[str]) -> DataFrame:
    """One row per basket: sorted distinct ``items``, the multiset as ``(item, n)`` structs, and
    ``basket_size`` counting repeated items (the reference counts the raw list length)."""
    keys = list(basket_cols)
    return item_counts.groupBy(*keys).agg(
        F.array_sort(F.collect_list("item")).alias(ITEMS),
        F.array_sort(F.collect_list(F.struct("item", "n"))).alias("item_counts"),
        F.sum("n").alias("basket_size"),
    )


def transactions(item_counts: DataFrame, basket_cols: Sequence[str]) -> DataFrame:
    """E3 in long form: distinct ``(basket..., item)`` pairs (the true cells of the one-hot matrix)."""
    return item_counts.select(*basket_cols, "item")


def basket_onehot_wide(pairs: DataFrame, basket_cols: Sequence[str], items: Sequence[str]) -> DataFrame:
    """E3 wide form for a known, small item list (columns sorted like the reference's encoder)."""
    return (pairs.groupBy(*basket_cols).pivot("item", sorted(items))
            .agg(F.lit(True)).na.fill(False))


def count_baskets(pairs: DataFrame, basket_cols: Sequence[str]) -> int:
    return pairs.select(*basket_cols).distinct().count()


# ---------------------------------------------------------------------------------------------------------
# Level-wise frequent itemsets


def _support_ok(freq: Column, n: int, min_support: float) -> Column:
    return (freq / F.lit(float(n))) >= F.lit(float(min_support))


def frequent_itemsets_levelwise(pairs: DataFrame, basket_cols: Sequence[str], min_support: float,
                                max_len: int | None = None, n_baskets: int | None = None) -> DataFrame:
    """Apriori-style counting: ``(items, freq, support, size)`` for every itemset with
    ``freq / n_baskets >= min_support`` and ``size <= max_len``.

    Level k extends each basket's frequent (k-1)-itemsets with larger frequent items of the same basket, inside the
    basket's row, then counts candidates with a hash aggregate.
    """
    keys = list(basket_cols)
    n = n_baskets if n_baskets is not None else count_baskets(pairs, keys)
    spark = pairs.sparkSession
    if n == 0:
        return spark.createDataFrame([], "items array<string>, freq bigint, support double, size int")

    item_freq = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))
    frequent_items = item_freq.where(_support_ok(F.col("freq"), n, min_support))
    # dense integer ids in item order: itemset aggregates then shuffle ints, not strings, and a sorted id array is
    # also a sorted name array. The window runs over the frequent items only (at most average basket size /
    # min_support rows).
    frequent_items = stored(frequent_items.select(
        "item", "freq", (F.row_number().over(Window.orderBy("item")) - 1).cast("int").alias("iid")), "items")
    levels = [frequent_items.select(F.array("iid").alias(ITEMS), "freq")]

    # one row per basket: its frequent items as sorted ids
    ids = frequent_items.select("item", "iid")
    baskets = cut_lineage(pairs.join(ids, "item").groupBy(*keys).agg(
        F.array_sort(F.collect_list("iid")).alias("_ids")).select("_ids"))
    # the basket's frequent sets of the last level, each with its items beyond the set
    occ = baskets.select("_ids", F.explode("_ids").alias("_last")).select("_ids", F.array("_last").alias(ITEMS))

    k = 1
    while max_len is None or k < max_len:
        k += 1
        longer = F.filter("_ids", lambda x: x > F.element_at(ITEMS, -1))
        cand = occ.select("_ids", ITEMS, F.explode(longer).alias("_next")).select(
            "_ids", F.concat(ITEMS, F.array("_next")).alias(ITEMS))
        counts = cand.groupBy(ITEMS).agg(F.count(F.lit(1)).alias("freq"))
        frequent_k = stored(counts.where(_support_ok(F.col("freq"), n, min_support)), "level")
        if frequent_k.isEmpty():
            break
        levels.append(frequent_k)
        occ = cand.join(frequent_k.select(ITEMS), ITEMS, "left_semi").select("_ids", ITEMS)
        if k > 2:            # or every level would make all levels before it again
            occ = cut_lineage(occ)

    out = levels[0]
    for lvl in levels[1:]:
        out = out.unionByName(lvl)
    # back to names, over the (small) result table only
    named = (out.select(ITEMS, "freq", F.posexplode(ITEMS).alias("_pos", "iid"))
             .join(frequent_items.select("iid", "item"), "iid")
             .groupBy(ITEMS, "freq").agg(F.array_sort(F.collect_list(F.struct("_pos", "item"))).alias("_n"))
             .select(F.col("_n.item").alias(ITEMS), "freq"))
    return named.select(ITEMS, "freq", (F.col("freq") / F.lit(float(n))).alias("support"),
                        F.size(ITEMS).alias("size"))


# ---------------------------------------------------------------------------------------------------------
# M3: FP-growth


def frequent_itemsets_fpgrowth(pairs: DataFrame, basket_cols: Sequence[str], min_support: float,
                               max_len: int | None = None, n_baskets: int | None = None) -> DataFrame:
    """Frequent itemsets by conditional FP-trees that never grow past ``max_len`` (:mod:`quarry.operators.fptree`).
    Same output contract as :func:`frequent_itemsets_levelwise`."""
    keys = list(basket_cols)
    spark = pairs.sparkSession
    n = n_baskets if n_baskets is not None else count_baskets(pairs, keys)
    if n == 0 or (max_len is not None and max_len < 1):
        return spark.createDataFrame([], "items array<string>, freq bigint, support double, size int")
    # the smallest count that passes the exact test
    least = max(1, math.ceil(min_support * n) - 1)
    while least / float(n) < float(min_support):
        least += 1
    common = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least)
    # the window runs over the frequent items only (at most average basket size / min_support rows)
    common = stored(common.select("item", (F.row_number().over(
        Window.orderBy(F.desc("freq"), "item")) - 1).cast("int").alias("iid")), "items")
    sets = pairs.join(common, "item").groupBy(*keys).agg(F.array_sort(F.collect_list("iid")).alias(ITEMS)).select(ITEMS)
    found = fptree.mine(sets, least, max_len).withColumn("_set", F.monotonically_increasing_id())
    found = stored(found, "itemsets")
    named = (found.select("_set", "freq", F.explode(ITEMS).alias("iid")).join(common, "iid")
             .groupBy("_set", "freq").agg(F.array_sort(F.collect_list("item")).alias(ITEMS)))
    return named.select(ITEMS, "freq", (F.col("freq") / F.lit(float(n))).alias("support"), F.size(ITEMS).alias("size"))


def compare_itemsets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per itemset size, how many sets each method found and how many differ (both ways)."""
    ka = a.select(ITEMS, "freq", "size")
    kb = b.select(ITEMS, "freq", "size")
    only_a = ka.exceptAll(kb).groupBy("size").agg(F.count(F.lit(1)).alias("only_a"))
    only_b = kb.exceptAll(ka).groupBy("size").agg(F.count(F.lit(1)).alias("only_b"))
    ca = ka.groupBy("size").agg(F.count(F.lit(1)).alias("n_a"))
    cb = kb.groupBy("size").agg(F.count(F.lit(1)).alias("n_b"))
    out = (ca.join(cb, "size", "full").join(only_a, "size", "left").join(only_b, "size", "left"))
    return out.select(
        "size", F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"),
        (F.coalesce("only_a", F.lit(0)) + F.coalesce("only_b", F.lit(0))).alias("mismatches"))


# ---------------------------------------------------------------------------------------------------------
# Association rules


def association_rules(itemsets: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Every split of every frequent itemset into antecedent ⇒ consequent (any sizes), kept when
    ``confidence >= min_confidence``.

    Splits are bit masks ``1 .. 2^k - 2`` over the sorted item array; the supports of both sides are two
    equi-joins on the (sorted array) itemset key. Measures: confidence, lift, leverage, conviction
    (``+inf`` when confidence is 1). A set of k items has 2^k - 2 splits; sets of more than ``MOST_ITEMS`` are an error.
    """
    sets = itemsets.select(ITEMS, "support")
    multi = sets.where(F.size(ITEMS) >= 2)
    few = F.when(F.size(ITEMS) <= MOST_ITEMS, F.size(ITEMS)).otherwise(F.raise_error(F.lit(
        f"rules of itemsets of more than {MOST_ITEMS} items"))).cast("int")
    mask = F.explode(F.sequence(F.lit(1).cast("long"), F.pow(F.lit(2.0), few).cast("long") - 2)).alias("mask")
    splits = multi.select(ITEMS, "support", mask)

    def side(bit: int) -> Column:
        return F.expr(f"filter(items, (x, i) -> (shiftright(mask, i) & 1) = {bit})")

    splits = splits.select(side(1).alias("antecedents"), side(0).alias("consequents"), "support")
    lookup = stored(sets, "sets")
    a = lookup.select(F.col(ITEMS).alias("antecedents"), F.col("support").alias("antecedent_support"))
    c = lookup.select(F.col(ITEMS).alias("consequents"), F.col("support").alias("consequent_support"))
    rules = splits.join(a, "antecedents").join(c, "consequents")
    conf = F.col("support") / F.col("antecedent_support")
    rules = rules.select(
        "antecedents", "consequents", "antecedent_support", "consequent_support", "support",
        conf.alias("confidence"))
    rules = rules.where(F.col("confidence") >= F.lit(float(min_confidence)))
    return rules.select(
        "*",
        (F.col("confidence") / F.col("consequent_support")).alias("lift"),
        (F.col("support") - F.col("antecedent_support") * F.col("consequent_support")).alias("leverage"),
        F.when(F.col("confidence") == 1.0, F.lit(float("inf")))
         .otherwise((1.0 - F.col("consequent_support")) / (1.0 - F.col("confidence"))).alias("conviction"),
    )


def rule_order() -> list[Column]:
    """Deterministic rule order: lift desc, then confidence, support, antecedent, consequent."""
    return [F.col("lift").desc(), F.col("confidence").desc(), F.col("support").desc(),
            F.array_join("antecedents", "|"), F.array_join("consequents", "|")]


def positive_rules(rules: DataFrame, min_lift: float = 1.0) -> DataFrame:
    """M6 filter: strictly positive association (``lift > min_lift``)."""
    return rules.where(F.col("lift") > F.lit(float(min_lift)))


def top_rules(rules: DataFrame, n: int = 20) -> DataFrame:
    """M6 / L1: the n strongest rules (TakeOrdered: only n rows per task travel)."""
    return rules.orderBy(*rule_order()).limit(n)


def strongest_rule(rules: DataFrame) -> DataFrame:
    """The single best rule, or an empty frame when there is none."""
    return top_rules(rules, 1)


def rule_item_counts(rules: DataFrame, side: str = "antecedents", n: int = 10) -> DataFrame:
    """How many rules each item appears in on one side; top n by count then item."""
    counts = rules.select(F.explode(side).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("rules"))
    return counts.orderBy(F.col("rules").desc(), "item").limit(n)


def category_best_rule(rules: DataFrame, categories: dict[str, Sequence[str]]) -> DataFrame:
    """M9: per category (a literal item list), the best rule whose antecedent holds any of its items.

    Categories without a matching rule are kept with null rule columns. The category table is a literal
    (bounded by the caller's dict), so broadcasting it is safe.
    """
    spark = rules.sparkSession
    cat_rows = [(name, item) for name, items in categories.items() for item in items]
    cats = spark.createDataFrame(cat_rows, "category string, item string")
    names = spark.createDataFrame([(n,) for n in categories], "category string")
    exploded = rules.select("*", F.explode("antecedents").alias("item"))
    matched = exploded.join(F.broadcast(cats), "item").drop("item").dropDuplicates(
        ["category", "antecedents", "consequents"])
    w = Window.partitionBy("category").orderBy(*rule_order())
    best = matched.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return names.join(best, "category", "left")   # at most a rule per category on the other side


# ---------------------------------------------------------------------------------------------------------
# Recommendations for every basket


def recommend(pairs: DataFrame, basket_cols: Sequence[str], rules: DataFrame, top_n: int = 5) -> DataFrame:
    """For every basket: rules whose antecedent is contained in the basket, their consequent items not
    already in it, the best rule per recommended item (highest lift; ties: confidence, support,
    antecedent), then the top ``top_n`` items per basket by that lift.

    The containment (theta) join is rewritten as an equi-join: a rule meets the baskets that hold the rarest item of its
    antecedent, so most baskets never meet it, and the rest is tested inside the basket's row, which carries its distinct items (bounded by the item
    vocabulary). The baskets are dealt by their key once; everything after stays there. The rule table is stored, so
    Spark broadcasts it by its size in bytes; past that the join on the item is shuffled and split where it is skewed.
    """
    keys = list(basket_cols)
    told = stored(rules.select(F.monotonically_increasing_id().alias("_rule"), "antecedents", "consequents", "confidence",
                               "lift", "support"), "rules")
    count = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("_n"))
    # an item in no basket is the rarest, and its rule meets none
    rarest = (told.select("_rule", F.explode("antecedents").alias("item")).join(count, "item", "left")
              .groupBy("_rule").agg(F.min_by("item", F.struct(F.coalesce("_n", F.lit(0)), "item")).alias("item")))
    r = stored(told.join(rarest, "_rule").drop("_rule"), "rules")
    held = pairs.select(*keys, "item").groupBy(*keys).agg(F.collect_set("item").alias("_items"))
    hits = held.select(*keys, "_items", F.explode("_items").alias("item")).join(r, "item")
    contained = hits.where(F.size(F.array_except("antecedents", "_items")) == 0)
    cands = contained.select(*keys, "antecedents", "confidence", "lift", "support", F.explode(
        F.array_except("consequents", "_items")).alias("item"))
    # best rule per (basket, item): highest lift, then confidence, support, smallest antecedent
    best = cands.groupBy(*keys, "item").agg(
        F.min_by(F.struct("confidence", "lift", "support", "antecedents"),
                 F.struct(-F.col("lift"), -F.col("confidence"), -F.col("support"),
                          F.array_join("antecedents", "|"))).alias("_best"))
    best = best.select(*keys, "item", "_best.confidence", "_best.lift", "_best.support")
    w = Window.partitionBy(*keys).orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                                          F.col("support").desc(), "item")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
            .select(*keys, "rank", "item", "confidence", "lift", "support"))


# ---------------------------------------------------------------------------------------------------------
# M11 / A13 / A16 / A15


def mining_summary(n_baskets: int, itemsets: DataFrame, rules: DataFrame) -> DataFrame:
    """One-row summary: baskets, itemsets, rules, mean confidence, median lift, rules with lift >= 2."""
    n_sets = itemsets.count()
    return rules.agg(
        F.lit(n_baskets).cast("bigint").alias("baskets"),
        F.lit(n_sets).cast("bigint").alias("itemsets"),
        F.count(F.lit(1)).alias("rules"),
        F.avg("confidence").alias("mean_confidence"),
        F.median("lift").alias("median_lift"),
        F.count_if(F.col("lift") >= 2.0).alias("strong_rules"),
    )


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Fixed-width histogram with numpy's edges (max falls in the last bin, a constant column is
    centred in a ±0.5 range); empty bins are emitted with count 0. Two passes: min/max, then counts."""
    lo_hi = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if lo_hi is None or lo_hi["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    lo, hi = float(lo_hi["lo"]), float(lo_hi["hi"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    idx = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = edges.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"))
    return (edges.join(counts, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
