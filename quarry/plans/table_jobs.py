"""Cleaning, profiling, source/sink, join and set queries.

The generated tables have no nulls, so nulls and blank strings are injected with deterministic rules on
existing columns (FIXTURES §2); the same rules appear in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as S
from quarry.functions import text as tx
from quarry.operators import profile as P
from quarry.plans.tables import table
from quarry.session import scratch_path
from quarry.sources import files as io


def r6(c):
    return F.round(c, 6)


def _part_with_nulls(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey", "p_name", F.expr("nullif(p_brand, 'Brand#4')").alias("p_brand"),
        F.expr("CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_type END").alias("p_type"), "p_size",
        F.expr("CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END").alias("p_retailprice"))


PART_WITH_NULLS_SQL = """part_n AS (
    SELECT p_partkey, p_name, nullif(p_brand, 'Brand#4') AS p_brand,
           CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_type END AS p_type, p_size,
           CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice FROM part)"""


def q_null_audit(spark, sf_dir):
    _, report = P.drop_missing_report(_part_with_nulls(spark, sf_dir))
    return report


def q_distinct_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    stats = orders.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(orders.columns)).cast("bigint").alias("columns"),
        F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_orderpriority").alias("priorities"),
        F.min(day).cast("string").alias("first_day"), F.max(day).cast("string").alias("last_day"),
        r6(F.min("o_totalprice")).alias("min_price"), r6(F.max("o_totalprice")).alias("max_price"))
    return stats


def _charges(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    raw = F.expr("CASE WHEN p_size % 7 = 0 THEN ' ' WHEN p_size % 13 = 0 THEN 'n/a' "
                 "ELSE CAST(p_retailprice AS STRING) END")
    return part.select("p_partkey", raw.alias("charges_raw"))


def q_coerce_and_drop(spark, sf_dir):
    df = _charges(spark, sf_dir).select("p_partkey", S.to_number("charges_raw").alias("charges"))
    return P.drop_missing(df).select("p_partkey", r6("charges").alias("charges"))


def q_drop_fill_subset(spark, sf_dir):
    df = P.drop_missing(_part_with_nulls(spark, sf_dir), subset=["p_brand"])
    df = P.fill_missing(df, {"p_type": ""})
    return df.select("p_partkey", "p_brand", "p_type")


def q_dates_dayfirst(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderkey") % 100 == 0, F.lit("31-02-1995")).otherwise(
        F.date_format("o_orderdate", "dd-MM-yyyy"))
    df = orders.select("o_orderkey", raw.alias("date_raw"))
    return df.select("o_orderkey", "date_raw", S.parse_date("date_raw", "dd-MM-yyyy").cast("string").alias("day"))


PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}
STATUS_NAMES = ["F", "O", "P"]


def q_map_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_orderpriority",
                         S.map_values("o_orderpriority", PRIORITY_CODES).cast("int").alias("priority_code"),
                         F.array_position(F.array(*[F.lit(s) for s in STATUS_NAMES]), F.col("o_orderstatus"))
                         .cast("int").alias("status_code"))


def q_project_rename_filter(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    df = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                   "l_returnflag")                                           # P2
    df = df.drop("l_partkey")                                                # P1
    df = df.toDF("orderkey", "line", "qty", "price", "discount", "flag")     # P3
    df = df.where(F.col("flag") == "R").where(F.col("qty") > 10)             # P5, P6
    return df.select("orderkey", F.col("line").cast("string").alias("line"),  # P19
                     S.round_half_up(F.col("price") * (1 - F.col("discount")), 4).alias("net"),  # P18
                     F.size(F.split(F.col("flag"), "")).alias("flag_len"))   # P4


def q_value_counts(spark, sf_dir):
    return P.value_counts(table(spark, sf_dir, "documents"), "lang")


LANG_ORDER = ["en", "fr", "de", "es", "it"]


def q_ordered_counts(spark, sf_dir):
    return P.ordered_counts(table(spark, sf_dir, "documents"), "lang", LANG_ORDER)


def q_group_means(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").drop("l_shipdate", "l_linestatus")
    means = P.group_means(li, "l_returnflag")
    return means.select("l_returnflag", *[r6(c).alias(c) for c in means.columns if c != "l_returnflag"])


def q_preview_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return P.top_n(li.select("l_orderkey", "l_linenumber", "l_partkey", r6("l_quantity").alias("l_quantity")),
                   5, [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity")])


def q_union_all(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    a = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", F.lit("status_f").alias("part"))
    b = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", F.lit("urgent").alias("part"))
    return a.unionByName(b)


CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def q_collection_round_trip(spark, sf_dir):
    path = scratch_path(spark, "collection")
    written = io.replace_collection(table(spark, sf_dir, "customer"), path)
    back = io.read_collection(spark, path, CUSTOMER_SCHEMA)
    assert written >= 0
    return back


def q_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    io.write_csv(table(spark, sf_dir, "part"), path, encoding="latin-1")
    return io.read_csv(spark, path, schema=PART_SCHEMA, encoding="latin-1")


def q_name_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select("p_name").distinct()
    ext = F.when(F.col("p_name").contains("gear"), F.lit(".jpg")).otherwise(F.lit(".PNG"))
    files = names.select(F.concat(F.lit("images/"), F.regexp_replace(F.upper("p_name"), " ", "_"), ext).alias("path"))
    files = (files.where(F.lower("path").endswith(".png"))
             .select(tx.file_stem("path").alias("name_clean"), "path").dropDuplicates(["name_clean"]))
    keyed = part.select("p_partkey", tx.normalize_key("p_name").alias("name_clean"))
    return keyed.join(files, "name_clean", "inner")


def q_feature_block_join(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("f_acctbal"),
        F.col("c_nationkey").cast("double").alias("f_nation"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(
        F.count(F.lit(1)).cast("double").alias("f_orders"), F.sum("o_totalprice").alias("f_spend"))
    joined = cust.join(orders, "key")
    feats = ["f_acctbal", "f_nation", "f_orders", "f_spend"]
    return joined.select("key", F.lit(len(feats)).alias("width"), *[r6(c).alias(c) for c in feats])


QUERIES = {
    "null_audit": q_null_audit,
    "distinct_counts": q_distinct_counts,
    "coerce_and_drop": q_coerce_and_drop,
    "drop_fill_subset": q_drop_fill_subset,
    "dates_dayfirst": q_dates_dayfirst,
    "map_values": q_map_values,
    "project_rename_filter": q_project_rename_filter,
    "value_counts": q_value_counts,
    "ordered_counts": q_ordered_counts,
    "group_means": q_group_means,
    "preview_rows": q_preview_rows,
    "union_all": q_union_all,
    "collection_round_trip": q_collection_round_trip,
    "csv_scan": q_csv_scan,
    "name_lookup": q_name_lookup,
    "feature_block_join": q_feature_block_join,
}

_NUMERIC_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax"]

SQL = {
    "null_audit": f"""WITH {PART_WITH_NULLS_SQL},
    agg AS (SELECT count(*) AS rows_before,
                   count(*) FILTER (WHERE p_partkey IS NULL OR p_name IS NULL OR p_brand IS NULL OR p_type IS NULL
                                    OR p_size IS NULL OR p_retailprice IS NULL OR isnan(p_retailprice)) AS bad,
                   count(*) FILTER (WHERE p_brand IS NULL) AS n_brand,
                   count(*) FILTER (WHERE p_type IS NULL) AS n_type,
                   count(*) FILTER (WHERE p_retailprice IS NULL OR isnan(p_retailprice)) AS n_price FROM part_n)
    SELECT * FROM (
      SELECT 'p_brand' AS "column", n_brand AS nulls, rows_before, bad AS rows_removed,
             rows_before - bad AS rows_after FROM agg
      UNION ALL SELECT 'p_type', n_type, rows_before, bad, rows_before - bad FROM agg
      UNION ALL SELECT 'p_retailprice', n_price, rows_before, bad, rows_before - bad FROM agg) WHERE nulls > 0""",
    "distinct_counts": """
    SELECT count(*) AS rows, CAST(6 AS BIGINT) AS columns, count(DISTINCT o_custkey) AS customers,
           count(DISTINCT o_orderpriority) AS priorities, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_day,
           CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day, round(min(o_totalprice), 6) AS min_price,
           round(max(o_totalprice), 6) AS max_price FROM orders""",
    "coerce_and_drop": """
    SELECT p_partkey, round(charges, 6) AS charges FROM (
      SELECT p_partkey, TRY_CAST(CASE WHEN p_size % 7 = 0 THEN ' ' WHEN p_size % 13 = 0 THEN 'n/a'
                                      ELSE CAST(p_retailprice AS VARCHAR) END AS DOUBLE) AS charges FROM part)
    WHERE charges IS NOT NULL AND NOT isnan(charges)""",
    "drop_fill_subset": f"""WITH {PART_WITH_NULLS_SQL}
    SELECT p_partkey, p_brand, coalesce(p_type, '') AS p_type FROM part_n WHERE p_brand IS NOT NULL""",
    "dates_dayfirst": """
    SELECT o_orderkey, date_raw, CAST(CAST(try_strptime(date_raw, '%d-%m-%Y') AS DATE) AS VARCHAR) AS day FROM (
      SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN '31-02-1995'
                              ELSE strftime(o_orderdate, '%d-%m-%Y') END AS date_raw FROM orders)""",
    "map_values": """
    SELECT o_orderkey, o_orderpriority,
           CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                                     WHEN '5-LOW' THEN 5 END AS INTEGER) AS priority_code,
           CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 ELSE 0 END AS INTEGER) AS status_code
    FROM orders""",
    "project_rename_filter": """
    SELECT l_orderkey AS orderkey, CAST(l_linenumber AS VARCHAR) AS line,
           round(l_extendedprice * (1 - l_discount), 4) AS net, CAST(length(l_returnflag) AS INTEGER) AS flag_len
    FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 10""",
    "value_counts": """
    SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang""",
    "ordered_counts": """
    SELECT CAST(o.position AS INTEGER) AS position, o.lang, CAST(coalesce(c.n, 0) AS BIGINT) AS count
    FROM (VALUES (0, 'en'), (1, 'fr'), (2, 'de'), (3, 'es'), (4, 'it')) o(position, lang)
    LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) c ON o.lang = c.lang""",
    "group_means": "SELECT l_returnflag, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in _NUMERIC_LI)
                   + " FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag",
    "preview_rows": """
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity, 6) AS l_quantity FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity LIMIT 5""",
    "union_all": """
    SELECT o_orderkey, 'status_f' AS part FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "collection_round_trip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "csv_scan": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "name_lookup": """
    WITH files AS (SELECT DISTINCT lower(regexp_extract(path, '([^/]+)\\.[^./]*$', 1)) AS name_clean, path FROM (
        SELECT 'images/' || replace(upper(p_name), ' ', '_') ||
               CASE WHEN contains(p_name, 'gear') THEN '.jpg' ELSE '.PNG' END AS path FROM (SELECT DISTINCT p_name FROM part))
      WHERE ends_with(lower(path), '.png'))
    SELECT p.p_partkey, p.name_clean, f.path FROM (
      SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '_', 'g') AS name_clean FROM part) p
    JOIN files f ON p.name_clean = f.name_clean""",
    "feature_block_join": """
    SELECT c.c_custkey AS key, 4 AS width, round(c.c_acctbal, 6) AS f_acctbal,
           round(CAST(c.c_nationkey AS DOUBLE), 6) AS f_nation, round(CAST(o.n AS DOUBLE), 6) AS f_orders,
           round(o.spend, 6) AS f_spend
    FROM customer c JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey) o
      ON c.c_custkey = o.o_custkey""",
}
