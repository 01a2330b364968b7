"""Streaming entry points and physical-plan checks."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import baskets as B
from quarry.plans import basket_jobs, text_jobs
from quarry.plans.tables import purchase_lines
from quarry.streaming import score


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_recommend_stream_matches_batch(spark, small_dir):
    m = basket_jobs.Mining(spark, small_dir)
    rules = m.positive
    base = tempfile.mkdtemp(prefix="quarry-stream-")
    src = os.path.join(base, "in")
    purchase_lines(spark, small_dir).write.parquet(src)
    lines = spark.readStream.schema("member long, day date, item string").parquet(src)
    q = score.recommend_stream(lines, ["member", "day"], "item", rules, os.path.join(base, "out"),
                               os.path.join(base, "ckpt"), top_n=3)
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(base, "out")).drop("batch_id")
    batch = B.recommend(m.pairs, ["member", "day"], rules, 3)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_clean_text_stream(spark, small_dir):
    base = tempfile.mkdtemp(prefix="quarry-stream-text-")
    spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").write.parquet(base + "/in")
    s = spark.readStream.schema("doc_id long, text string").parquet(base + "/in")
    q = (score.clean_text_stream(s, "text").writeStream.format("memory").queryName("cleaned")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.sql("SELECT count(*) FROM cleaned").first()[0] == spark.read.parquet(base + "/in").count()


def test_text_cleaning_stays_in_the_jvm(spark, small_dir):
    plan = _plan(text_jobs.q_clean_text(spark, small_dir))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_recommend_has_no_cartesian_product(spark, small_dir):
    m = basket_jobs.Mining(spark, small_dir)
    plan = _plan(B.recommend(m.pairs, ["member", "day"], m.positive, 3))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark, small_dir):
    li = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    df = li.where(F.col("l_returnflag") == "R").select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_bigrams_never_recompute_cleaning_in_lambda(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma delta")], "id int, text string")
    d = df.select("id", tx.clean_tokens("text").alias("t")).select(tx.with_bigrams("t").alias("g"))
    assert d.first()["g"] == ["alpha", "beta", "gamma", "delta", "alpha beta", "beta gamma", "gamma delta"]


def test_top_n_per_group_is_limited_before_the_shuffle(spark, small_dir):
    plan = _plan(text_jobs.q_class_terms_top(spark, small_dir))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    m = basket_jobs.Mining(spark, small_dir)
    plan = _plan(B.recommend(m.pairs, ["member", "day"], m.positive, 3))
    assert "WindowGroupLimit" in plan   # no shuffle lies between: the baskets are already together
