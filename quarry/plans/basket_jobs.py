"""Basket-mining queries over orders ⋈ lineitem ⋈ part, with their DuckDB oracles.

Baskets are one per customer per order day; items are ``p_brand`` (25 values) or ``p_type``.
The reference's confidence 0.5 finds no brand rules in the generated data, so the thresholds are those
of FIXTURES §2: support 0.01, length ≤ 3, confidence 0.1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import baskets as B
from quarry.operators import profile as P
from quarry.plans.tables import BASKET_KEYS, purchase_lines, purchase_lines_sql
from quarry.session import cut_lineage

KEYS = list(BASKET_KEYS)
MIN_SUPPORT = 0.01
MAX_LEN = 3
MIN_CONFIDENCE = 0.1
TOP_RULES = 20
TOP_ITEMS = 10
TOP_RECS = 3

# Fixed category lists for the best-rule-per-category report. The last brand of the first list carries a
# trailing blank on purpose (never trimmed, as in the reference), and the third list matches nothing.
CATEGORIES = {
    "low": ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5 "],
    "mid": ["Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15"],
    "none": ["Brand#99"],
}


def r6(c) -> F.Column:
    return F.round(c, 6)


def _set_str(c: str) -> F.Column:
    return F.array_join(c, "|")


class Mining:
    """Shared, lazily-built stages of one mining run (pairs → itemsets → rules)."""

    def __init__(self, spark: SparkSession, sf_dir: str, item_col: str = "p_brand",
                 min_support: float = MIN_SUPPORT, max_len: int = MAX_LEN,
                 min_confidence: float = MIN_CONFIDENCE):
        self.spark, self.sf_dir, self.item_col = spark, sf_dir, item_col
        self.min_support, self.max_len, self.min_confidence = min_support, max_len, min_confidence
        self._pairs = self._n = self._sets = self._rules = None

    @property
    def counts(self) -> DataFrame:
        return B.basket_item_counts(purchase_lines(self.spark, self.sf_dir, self.item_col), KEYS, "item")

    @property
    def pairs(self) -> DataFrame:
        if self._pairs is None:
            self._pairs = cut_lineage(B.transactions(self.counts, KEYS))
        return self._pairs

    @property
    def n_baskets(self) -> int:
        if self._n is None:
            self._n = B.count_baskets(self.pairs, KEYS)
        return self._n

    def itemsets(self, method: str = "levelwise") -> DataFrame:
        if method == "fpgrowth":
            return B.frequent_itemsets_fpgrowth(self.pairs, KEYS, self.min_support, self.max_len, self.n_baskets)
        if self._sets is None:
            self._sets = cut_lineage(B.frequent_itemsets_levelwise(
                self.pairs, KEYS, self.min_support, self.max_len, self.n_baskets))
        return self._sets

    @property
    def rules(self) -> DataFrame:
        if self._rules is None:
            self._rules = cut_lineage(B.association_rules(self.itemsets(), self.min_confidence))
        return self._rules

    @property
    def positive(self) -> DataFrame:
        return B.positive_rules(self.rules)


def rule_columns(df: DataFrame) -> DataFrame:
    return df.select(
        _set_str("antecedents").alias("antecedents"), _set_str("consequents").alias("consequents"),
        *[r6(c).alias(c) for c in ("antecedent_support", "consequent_support", "support", "confidence",
                                   "lift", "leverage", "conviction")])


# ---------------------------------------------------------------------------------------------------------
# queries


def q_basket_lists(spark, sf_dir):
    m = Mining(spark, sf_dir)
    lists = B.basket_lists(m.counts, KEYS)
    return lists.select("member", F.col("day").cast("string").alias("day"),
                        _set_str(B.ITEMS).alias("items"), F.col("basket_size").cast("bigint").alias("basket_size"))


def q_basket_size_summary(spark, sf_dir):
    m = Mining(spark, sf_dir)
    sizes = P.describe(cut_lineage(B.basket_lists(m.counts, KEYS).select("basket_size")), "basket_size")
    return sizes.select("count", r6("mean").alias("mean"), r6("std").alias("std"), F.col("min").cast("bigint").alias("min"),
                        *[r6(c).alias(c) for c in ("p25", "p50", "p75")], F.col("max").cast("bigint").alias("max"),
                        r6("p50").alias("median"))


def q_item_frequency_top(spark, sf_dir):
    m = Mining(spark, sf_dir)
    freq = m.pairs.groupBy("item").agg(F.count(F.lit(1)).alias("baskets"))
    return (freq.orderBy(F.col("baskets").desc(), "item").limit(TOP_ITEMS)
            .select("item", "baskets", r6(F.col("baskets") / F.lit(float(m.n_baskets))).alias("support")))


def _itemset_columns(df):
    return df.select(_set_str(B.ITEMS).alias("items"), "freq", r6("support").alias("support"),
                     F.col("size").cast("int").alias("size"))


def q_itemsets_levelwise(spark, sf_dir):
    return _itemset_columns(Mining(spark, sf_dir).itemsets("levelwise"))


def q_itemsets_fpgrowth(spark, sf_dir):
    return _itemset_columns(Mining(spark, sf_dir).itemsets("fpgrowth"))


def q_itemsets_compared(spark, sf_dir):
    m = Mining(spark, sf_dir, item_col="p_type")
    cmp = B.compare_itemsets(m.itemsets("levelwise"), m.itemsets("fpgrowth"))
    return cmp.select(F.col("size").cast("int").alias("size"), F.col("n_a").cast("bigint").alias("n_levelwise"),
                      F.col("n_b").cast("bigint").alias("n_fpgrowth"),
                      F.col("mismatches").cast("bigint").alias("mismatches"))


def q_rules_brand(spark, sf_dir):
    return rule_columns(Mining(spark, sf_dir).rules)


def q_rules_type_multi(spark, sf_dir):
    return rule_columns(Mining(spark, sf_dir, item_col="p_type").rules)


def q_rules_positive_top(spark, sf_dir):
    m = Mining(spark, sf_dir)
    return rule_columns(B.top_rules(m.positive, TOP_RULES))


def q_rule_item_counts(spark, sf_dir):
    m = Mining(spark, sf_dir)
    pos = m.positive
    a = B.rule_item_counts(pos, "antecedents", TOP_ITEMS).select(F.lit("antecedent").alias("side"), "*")
    c = B.rule_item_counts(pos, "consequents", TOP_ITEMS).select(F.lit("consequent").alias("side"), "*")
    return a.unionByName(c)


def q_strongest_rule(spark, sf_dir):
    return rule_columns(B.strongest_rule(Mining(spark, sf_dir).positive))


def q_category_best_rule(spark, sf_dir):
    best = B.category_best_rule(Mining(spark, sf_dir).positive, CATEGORIES)
    return best.select("category", _set_str("antecedents").alias("antecedents"),
                       _set_str("consequents").alias("consequents"), r6("lift").alias("lift"),
                       r6("confidence").alias("confidence"))


def q_recommend_baskets(spark, sf_dir):
    m = Mining(spark, sf_dir)
    recs = B.recommend(m.pairs, KEYS, m.positive, TOP_RECS)
    return recs.select("member", F.col("day").cast("string").alias("day"), "rank", "item",
                       r6("confidence").alias("confidence"), r6("lift").alias("lift"), r6("support").alias("support"))


def q_mining_summary(spark, sf_dir):
    m = Mining(spark, sf_dir)
    s = B.mining_summary(m.n_baskets, m.itemsets(), m.positive)
    return s.select("baskets", "itemsets", "rules", r6("mean_confidence").alias("mean_confidence"),
                    r6("median_lift").alias("median_lift"), "strong_rules")


def q_lift_histogram(spark, sf_dir):
    h = B.histogram(Mining(spark, sf_dir).positive, "lift", 30)
    return h.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "count")


def q_basket_onehot(spark, sf_dir):
    """E3 long form: one row per true cell of the transaction matrix."""
    m = Mining(spark, sf_dir)
    return m.pairs.select("member", F.col("day").cast("string").alias("day"), "item")


QUERIES = {
    "basket_lists": q_basket_lists,
    "basket_size_summary": q_basket_size_summary,
    "item_frequency_top": q_item_frequency_top,
    "itemsets_levelwise": q_itemsets_levelwise,
    "itemsets_fpgrowth": q_itemsets_fpgrowth,
    "itemsets_compared": q_itemsets_compared,
    "rules_brand": q_rules_brand,
    "rules_type_multi": q_rules_type_multi,
    "rules_positive_top": q_rules_positive_top,
    "rule_item_counts": q_rule_item_counts,
    "strongest_rule": q_strongest_rule,
    "category_best_rule": q_category_best_rule,
    "recommend_baskets": q_recommend_baskets,
    "mining_summary": q_mining_summary,
    "lift_histogram": q_lift_histogram,
    "basket_onehot": q_basket_onehot,
}


# ---------------------------------------------------------------------------------------------------------
# DuckDB oracle SQL


def _ctes(item_col: str = "p_brand", with_rules: bool = False) -> str:
    s = f"{MIN_SUPPORT}::DOUBLE"
    body = f"""
    lines AS ({purchase_lines_sql(item_col)}),
    pairs AS (SELECT DISTINCT member, day, item FROM lines
              WHERE member IS NOT NULL AND day IS NOT NULL AND item IS NOT NULL),
    nb AS (SELECT count(*) AS n FROM (SELECT DISTINCT member, day FROM pairs)),
    f1 AS (SELECT item, count(*) AS freq FROM pairs GROUP BY item
           HAVING count(*) / (SELECT n FROM nb) >= {s}),
    p1 AS (SELECT p.* FROM pairs p JOIN f1 USING (item)),
    c2 AS (SELECT a.item AS i1, b.item AS i2, count(*) AS freq
           FROM p1 a JOIN p1 b ON a.member = b.member AND a.day = b.day AND a.item < b.item
           GROUP BY ALL HAVING count(*) / (SELECT n FROM nb) >= {s}),
    c3 AS (SELECT a.item AS i1, b.item AS i2, c.item AS i3, count(*) AS freq
           FROM p1 a JOIN p1 b ON a.member = b.member AND a.day = b.day AND a.item < b.item
                     JOIN p1 c ON a.member = c.member AND a.day = c.day AND b.item < c.item
           GROUP BY ALL HAVING count(*) / (SELECT n FROM nb) >= {s}),
    sets AS (
      SELECT items, array_to_string(items, '|') AS skey, freq, freq / (SELECT n FROM nb) AS support,
             len(items) AS size
      FROM (SELECT [item] AS items, freq FROM f1
            UNION ALL SELECT [i1, i2], freq FROM c2
            UNION ALL SELECT [i1, i2, i3], freq FROM c3))"""
    if with_rules:
        body += f""",
    splits AS (SELECT items, support, unnest(range(1, (1 << len(items)) - 1)) AS mask FROM sets
               WHERE len(items) >= 2),
    sides AS (SELECT list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS ant,
                     list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 0) AS cons, support FROM splits),
    rules0 AS (SELECT s.ant, s.cons, a.support AS antecedent_support, c.support AS consequent_support,
                      s.support, s.support / a.support AS confidence
               FROM sides s JOIN sets a ON array_to_string(s.ant, '|') = a.skey
                            JOIN sets c ON array_to_string(s.cons, '|') = c.skey),
    rules AS (SELECT ant, cons, array_to_string(ant, '|') AS antecedents,
                     array_to_string(cons, '|') AS consequents,
                     antecedent_support, consequent_support, support, confidence,
                     confidence / consequent_support AS lift,
                     support - antecedent_support * consequent_support AS leverage,
                     CASE WHEN confidence = 1 THEN 'inf'::DOUBLE
                          ELSE (1 - consequent_support) / (1 - confidence) END AS conviction
              FROM rules0 WHERE confidence >= {MIN_CONFIDENCE}::DOUBLE),
    pos AS (SELECT * FROM rules WHERE lift > 1)"""
    return "WITH " + body.strip()


RULE_COLS = """antecedents, consequents, round(antecedent_support, 6) AS antecedent_support,
  round(consequent_support, 6) AS consequent_support, round(support, 6) AS support,
  round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(leverage, 6) AS leverage,
  round(conviction, 6) AS conviction"""

RULE_ORDER = "lift DESC, confidence DESC, support DESC, antecedents, consequents"


def _cat_values() -> str:
    rows = [f"('{c}', '{i}')" for c, items in CATEGORIES.items() for i in items]
    return ", ".join(rows)


SQL = {
    "basket_lists": _ctes() + """
    SELECT member, CAST(day AS VARCHAR) AS day, array_to_string(list_sort(list(DISTINCT item)), '|') AS items,
           CAST(count(*) AS BIGINT) AS basket_size
    FROM lines WHERE member IS NOT NULL AND day IS NOT NULL AND item IS NOT NULL
    GROUP BY member, day""",
    "basket_size_summary": _ctes() + """,
    sizes AS (SELECT member, day, count(*) AS basket_size FROM lines
              WHERE member IS NOT NULL AND day IS NOT NULL AND item IS NOT NULL GROUP BY member, day)
    SELECT count(*) AS count, round(avg(basket_size), 6) AS mean, round(stddev_samp(basket_size), 6) AS std,
           CAST(min(basket_size) AS BIGINT) AS min, round(quantile_cont(basket_size, 0.25), 6) AS p25,
           round(quantile_cont(basket_size, 0.5), 6) AS p50, round(quantile_cont(basket_size, 0.75), 6) AS p75,
           CAST(max(basket_size) AS BIGINT) AS max, round(median(basket_size), 6) AS median FROM sizes""",
    "item_frequency_top": _ctes() + f"""
    SELECT item, count(*) AS baskets, round(count(*) / (SELECT n FROM nb), 6) AS support
    FROM pairs GROUP BY item ORDER BY baskets DESC, item LIMIT {TOP_ITEMS}""",
    "itemsets_levelwise": _ctes() + """
    SELECT skey AS items, freq, round(support, 6) AS support, CAST(size AS INTEGER) AS size FROM sets""",
    "itemsets_fpgrowth": _ctes() + """
    SELECT skey AS items, freq, round(support, 6) AS support, CAST(size AS INTEGER) AS size FROM sets""",
    "itemsets_compared": _ctes("p_type") + """
    SELECT CAST(size AS INTEGER) AS size, count(*) AS n_levelwise, count(*) AS n_fpgrowth,
           CAST(0 AS BIGINT) AS mismatches FROM sets GROUP BY size""",
    "rules_brand": _ctes(with_rules=True) + f"\n    SELECT {RULE_COLS} FROM rules",
    "rules_type_multi": _ctes("p_type", with_rules=True) + f"\n    SELECT {RULE_COLS} FROM rules",
    "rules_positive_top": _ctes(with_rules=True) + f"""
    SELECT {RULE_COLS} FROM pos ORDER BY {RULE_ORDER} LIMIT {TOP_RULES}""",
    "rule_item_counts": _ctes(with_rules=True) + f""",
    a AS (SELECT 'antecedent' AS side, item, count(*) AS rules
          FROM (SELECT unnest(ant) AS item FROM pos) GROUP BY item ORDER BY rules DESC, item LIMIT {TOP_ITEMS}),
    c AS (SELECT 'consequent' AS side, item, count(*) AS rules
          FROM (SELECT unnest(cons) AS item FROM pos) GROUP BY item ORDER BY rules DESC, item LIMIT {TOP_ITEMS})
    SELECT * FROM a UNION ALL SELECT * FROM c""",
    "strongest_rule": _ctes(with_rules=True) + f"""
    SELECT {RULE_COLS} FROM pos ORDER BY {RULE_ORDER} LIMIT 1""",
    "category_best_rule": _ctes(with_rules=True) + f""",
    cats AS (SELECT * FROM (VALUES {_cat_values()}) t(category, item)),
    names AS (SELECT DISTINCT category FROM cats),
    matched AS (SELECT DISTINCT c.category, p.antecedents, p.consequents, p.lift, p.confidence, p.support
                FROM (SELECT *, unnest(ant) AS item FROM pos) p JOIN cats c ON p.item = c.item),
    best AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {RULE_ORDER}) AS rn FROM matched)
    SELECT n.category, b.antecedents, b.consequents, round(b.lift, 6) AS lift,
           round(b.confidence, 6) AS confidence
    FROM names n LEFT JOIN (SELECT * FROM best WHERE rn = 1) b ON n.category = b.category""",
    "recommend_baskets": _ctes(with_rules=True) + f""",
    r AS (SELECT antecedents || '=>' || consequents AS rule_id, ant, cons, antecedents, confidence, lift, support
          FROM pos),
    ant_items AS (SELECT rule_id, len(ant) AS ant_size, unnest(ant) AS item FROM r),
    contained AS (SELECT p.member, p.day, a.rule_id FROM pairs p JOIN ant_items a ON p.item = a.item
                  GROUP BY p.member, p.day, a.rule_id, a.ant_size HAVING count(*) = a.ant_size),
    cons_items AS (SELECT rule_id, antecedents, confidence, lift, support, unnest(cons) AS item FROM r),
    cands AS (SELECT c.member, c.day, m.item, m.confidence, m.lift, m.support, m.antecedents
              FROM contained c JOIN cons_items m ON c.rule_id = m.rule_id
              WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.member = c.member AND p.day = c.day
                                AND p.item = m.item)),
    best AS (SELECT *, row_number() OVER (PARTITION BY member, day, item
                                          ORDER BY lift DESC, confidence DESC, support DESC, antecedents) AS rn
             FROM cands),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY member, day
                                            ORDER BY lift DESC, confidence DESC, support DESC, item) AS rk
               FROM best WHERE rn = 1)
    SELECT member, CAST(day AS VARCHAR) AS day, CAST(rk AS INTEGER) AS rank, item,
           round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support
    FROM ranked WHERE rk <= {TOP_RECS}""",
    "mining_summary": _ctes(with_rules=True) + """
    SELECT (SELECT n FROM nb) AS baskets, (SELECT count(*) FROM sets) AS itemsets, count(*) AS rules,
           round(avg(confidence), 6) AS mean_confidence, round(median(lift), 6) AS median_lift,
           count(*) FILTER (WHERE lift >= 2.0) AS strong_rules FROM pos""",
    "lift_histogram": _ctes(with_rules=True) + """,
    mm AS (SELECT CASE WHEN min(lift) = max(lift) THEN min(lift) - 0.5 ELSE min(lift) END AS lo,
                  CASE WHEN min(lift) = max(lift) THEN max(lift) + 0.5 ELSE max(lift) END AS hi FROM pos),
    binned AS (SELECT CAST(least(floor((lift - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin
               FROM pos, mm),
    counts AS (SELECT bin, count(*) AS count FROM binned GROUP BY bin),
    edges AS (SELECT CAST(b AS INTEGER) AS bin, lo + b * ((hi - lo) / 30) AS bin_lo,
                     lo + (b + 1) * ((hi - lo) / 30) AS bin_hi FROM range(30) t(b), mm)
    SELECT e.bin, round(e.bin_lo, 6) AS bin_lo, round(e.bin_hi, 6) AS bin_hi,
           CAST(coalesce(c.count, 0) AS BIGINT) AS count
    FROM edges e LEFT JOIN counts c ON e.bin = c.bin""",
    "basket_onehot": _ctes() + """
    SELECT member, CAST(day AS VARCHAR) AS day, item FROM pairs""",
}
