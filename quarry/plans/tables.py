"""Reading the generated tables and shaping the job inputs the reference scripts expect."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import spread

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one generated table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a table whose texts are cleaned or tokenised row by row before the first shuffle: that work is heavy, so a
    scan with fewer partitions than cores (one row group here) is dealt over all of them, see ``session.spread``."""
    return spread(table(spark, sf_dir, name))


BASKET_KEYS = ("member", "day")


def purchase_lines(spark: SparkSession, sf_dir: str, item_col: str = "p_brand") -> DataFrame:
    """One row per purchased item: ``member`` (customer), ``day`` (order date), ``item`` (a part attribute).

    Only the needed columns reach the scans (column pruning); the joins are left to AQE, which broadcasts
    ``part`` only when its measured size is under the threshold and splits skewed order keys.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("member"), F.to_date("o_orderdate").alias("day"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(item_col).alias("item"))
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .join(part, lines.l_partkey == part.p_partkey)
            .select("member", "day", "item"))


def purchase_lines_sql(item_col: str = "p_brand") -> str:
    """The same input as DuckDB SQL (a CTE body)."""
    return f"""
      SELECT o.o_custkey AS member, CAST(o.o_orderdate AS DATE) AS day, p.{item_col} AS item
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey"""
