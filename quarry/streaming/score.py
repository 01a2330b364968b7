"""Structured Streaming entry points: the reference has no streams and nothing stateful,
so only the stateless operators are offered on streaming DataFrames.

- text cleaning / tokenising (T1-T12) are plain Column expressions and apply to a stream unchanged;
- recommendation (M10) against a *static* rule table runs per micro-batch through ``foreachBatch`` (the
  batch operator needs a de-duplication and a top-N per basket, which are batch operations); baskets are
  taken as complete within a micro-batch;
- fitted ``pyspark.ml`` models ``transform`` streams directly.

Progress and exactly-once output are Spark's: a checkpoint location in the shared folder and an
idempotent sink (each micro-batch overwrites its own ``batch_id=`` partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.functions import text as tx
from quarry.operators import baskets as B


def clean_text_stream(stream: DataFrame, text_col: str, out: str = "clean") -> DataFrame:
    """T8 on a stream (stateless; the same expressions as the batch operator)."""
    return stream.withColumn(out, tx.clean_text(text_col))


def recommend_stream(lines: DataFrame, basket_cols: Sequence[str], item_col: str, rules: DataFrame, out_path: str,
                     checkpoint: str, top_n: int = 5, trigger_once: bool = True) -> StreamingQuery:
    """M10 per micro-batch: purchase lines → de-duplicated basket items → recommendations, appended under
    ``out_path/batch_id=N`` (rewritten as a whole on replay, so output stays exactly-once)."""
    keys = list(basket_cols)
    static_rules = rules.select("antecedents", "consequents", "confidence", "lift", "support")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        pairs = B.transactions(B.basket_item_counts(batch, keys, item_col), keys)
        recs = B.recommend(pairs, keys, static_rules, top_n)
        recs.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = lines.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()


def with_event_day(stream: DataFrame, ts_col: str, out: str = "day") -> DataFrame:
    """Basket day from an event timestamp (UTC), as the batch basket key."""
    return stream.withColumn(out, F.to_date(ts_col))
