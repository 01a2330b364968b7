"""Sampling, splitting and encoding queries. Membership is decided by
``md5(key|42|purpose)`` rank, which DuckDB computes identically, so every split is checked exactly."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import encode as E
from quarry.operators import sampling as X
from quarry.plans.tables import table

SEED = 42
TEST_SIZE = 0.2
FOLDS = 5


def r6(c):
    return F.round(c, 6)


def _urgent_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "c_mktsegment", "c_acctbal",
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"))


def q_undersample(spark, sf_dir):
    return X.undersample(_urgent_orders(spark, sf_dir), "urgent", ["o_orderkey"], SEED).select("o_orderkey", "urgent")


def q_undersample_then_split(spark, sf_dir):
    """X1 then X3, as the churn jobs do: rows per part and class; a part has the classes in equal shares."""
    kept = X.undersample(_urgent_orders(spark, sf_dir), "urgent", ["o_orderkey"], SEED).select("o_orderkey", "urgent")
    return X.plain_split(kept, ["o_orderkey"], TEST_SIZE, SEED).groupBy("split", "urgent").agg(
        F.count(F.lit(1)).alias("n"))


def q_shuffle_rows(spark, sf_dir):
    return X.shuffle_order(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], SEED)


def q_split_stratified(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return X.stratified_split(docs, "lang", ["doc_id"], TEST_SIZE, SEED).select("doc_id", "lang", "split")


def q_split_plain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return X.plain_split(docs, ["doc_id"], TEST_SIZE, SEED)


def q_folds(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return X.kfold(labelled, "quality", ["doc_id"], FOLDS, SEED).select("doc_id", "quality", "fold")


def q_label_codes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    coded, _ = E.label_encode(docs, "lang", "lang_code")
    return coded.select("doc_id", "lang", "lang_code")


def q_onehot_drop_first(spark, sf_dir):
    df = _urgent_orders(spark, sf_dir).select("o_orderkey", r6("o_totalprice").alias("o_totalprice"),
                                              "o_orderstatus", "c_mktsegment")
    return E.onehot_drop_first(df, E.text_columns(df), max_categories=100)


def q_standardise_all(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double"))
    z = E.fit_scaler(cust, ["c_acctbal", "c_nationkey"]).transform(cust)
    return z.select("c_custkey", r6("z_c_acctbal").alias("z_c_acctbal"), r6("z_c_nationkey").alias("z_c_nationkey"))


def q_standardise_train(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    split = X.plain_split(cust, ["c_custkey"], TEST_SIZE, SEED)
    scaler = E.fit_scaler(split.where(F.col("split") == "train"), ["c_acctbal"])
    return scaler.transform(split).select("c_custkey", "split", r6("z_c_acctbal").alias("z_c_acctbal"))


QUERIES = {
    "undersample": q_undersample,
    "undersample_then_split": q_undersample_then_split,
    "shuffle_rows": q_shuffle_rows,
    "split_stratified": q_split_stratified,
    "split_plain": q_split_plain,
    "folds": q_folds,
    "label_codes": q_label_codes,
    "onehot_drop_first": q_onehot_drop_first,
    "standardise_all": q_standardise_all,
    "standardise_train": q_standardise_train,
}


def md5_rank(key: str, by: str | None = None, purpose: str = "split") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return (f"row_number() OVER ({part}ORDER BY md5(concat_ws('|', CAST({key} AS VARCHAR), '{SEED}', '{purpose}')), "
            f"{key})")


def quota_sql(src: str, label: str) -> str:
    """CTEs computing ``quota(label, quota)``: test rows per class, largest-remainder allocation."""
    return f"""cls AS (SELECT {label}, count(*) AS cnt FROM {src} WHERE {label} IS NOT NULL GROUP BY {label}),
    t1 AS (SELECT *, sum(cnt) OVER () AS n FROM cls),
    t2 AS (SELECT *, ceil({TEST_SIZE}::DOUBLE * n) AS n_test FROM t1),
    t3 AS (SELECT *, cnt / n * (n - n_test) AS cont FROM t2),
    t4 AS (SELECT *, floor(cont) AS fl FROM t3),
    t5 AS (SELECT *, n - n_test - sum(fl) OVER () AS need,
                  row_number() OVER (ORDER BY cont - fl DESC, {label}) AS pos FROM t4),
    quota AS (SELECT {label}, cnt - (fl + CASE WHEN pos <= need THEN 1 ELSE 0 END) AS quota FROM t5)"""


URGENT_SQL = """src AS (SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, c.c_mktsegment, c.c_acctbal,
                       CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS urgent
                FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

SQL = {
    "undersample": f"""WITH {URGENT_SQL},
    r AS (SELECT o_orderkey, urgent, {md5_rank('o_orderkey', 'urgent', 'undersample')} AS rk FROM src)
    SELECT o_orderkey, urgent FROM r
    WHERE rk <= (SELECT min(cnt) FROM (SELECT urgent, count(*) AS cnt FROM src GROUP BY urgent))""",
    "undersample_then_split": f"""WITH {URGENT_SQL},
    r AS (SELECT o_orderkey, urgent, {md5_rank('o_orderkey', 'urgent', 'undersample')} AS rk FROM src),
    kept AS (SELECT o_orderkey, urgent FROM r
             WHERE rk <= (SELECT min(cnt) FROM (SELECT urgent, count(*) AS cnt FROM src GROUP BY urgent))),
    s AS (SELECT urgent, {md5_rank('o_orderkey')} AS rk FROM kept)
    SELECT CASE WHEN rk <= ceil({TEST_SIZE}::DOUBLE * (SELECT count(*) FROM kept)) THEN 'test' ELSE 'train' END AS split,
           urgent, count(*) AS n FROM s GROUP BY 1, 2""",
    "shuffle_rows": f"SELECT o_orderkey, {md5_rank('o_orderkey', purpose='shuffle')} AS shuffle_rank FROM orders",
    "split_stratified": f"""WITH src AS (SELECT doc_id, lang FROM documents), {quota_sql('src', 'lang')},
    r AS (SELECT doc_id, lang, {md5_rank('doc_id', 'lang')} AS rk FROM src WHERE lang IS NOT NULL)
    SELECT r.doc_id, r.lang, CASE WHEN r.rk <= q.quota THEN 'test' ELSE 'train' END AS split
    FROM r JOIN quota q ON r.lang = q.lang""",
    "split_plain": f"""WITH r AS (SELECT doc_id, {md5_rank('doc_id')} AS rk FROM documents)
    SELECT doc_id, CASE WHEN rk <= ceil({TEST_SIZE}::DOUBLE * (SELECT count(*) FROM documents)) THEN 'test'
                        ELSE 'train' END AS split FROM r""",
    "folds": f"""WITH src AS (SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, quality, CAST(({md5_rank('doc_id', 'quality', 'fold')} - 1) % {FOLDS} AS INTEGER) AS fold
    FROM src WHERE quality IS NOT NULL""",
    "label_codes": """WITH classes AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_code
                     FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))
    SELECT d.doc_id, d.lang, c.lang_code FROM documents d LEFT JOIN classes c ON d.lang = c.lang""",
    "onehot_drop_first": f"""WITH {URGENT_SQL}
    SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice,
           CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P,
           CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS c_mktsegment_BUILDING,
           CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS c_mktsegment_FURNITURE,
           CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS c_mktsegment_HOUSEHOLD,
           CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS c_mktsegment_MACHINERY FROM src""",
    "standardise_all": """WITH s AS (SELECT avg(c_acctbal) AS ma, stddev_pop(c_acctbal) AS sa,
                     avg(CAST(c_nationkey AS DOUBLE)) AS mn, stddev_pop(CAST(c_nationkey AS DOUBLE)) AS sn FROM customer)
    SELECT c_custkey, round((c_acctbal - ma) / CASE WHEN sa = 0 THEN 1 ELSE sa END, 6) AS z_c_acctbal,
           round((CAST(c_nationkey AS DOUBLE) - mn) / CASE WHEN sn = 0 THEN 1 ELSE sn END, 6) AS z_c_nationkey
    FROM customer, s""",
    "standardise_train": f"""WITH r AS (SELECT c_custkey, c_acctbal, {md5_rank('c_custkey')} AS rk FROM customer),
    sp AS (SELECT *, CASE WHEN rk <= ceil({TEST_SIZE}::DOUBLE * (SELECT count(*) FROM customer)) THEN 'test'
                          ELSE 'train' END AS split FROM r),
    s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM sp WHERE split = 'train')
    SELECT c_custkey, split, round((c_acctbal - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS z_c_acctbal
    FROM sp, s""",
}
