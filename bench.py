"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query is built and fully executed into Spark's ``noop`` sink (every row computed, nothing
collected); the time includes the jobs that build the query (supports, checkpoints). A query runs once to warm up, then
``BENCH_RUNS`` times (3); the median counts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.registry import QUERIES  # noqa: E402
from quarry.session import get_spark  # noqa: E402

HEADLINE = [
    "basket_lists",            # M1: group purchase lines into baskets
    "itemsets_levelwise",      # M2: level-wise frequent itemsets
    "itemsets_fpgrowth",       # M3: FP-growth frequent itemsets
    "rules_brand",             # M4/M5: all rules with measures
    "recommend_baskets",       # M10: recommendations for every basket
    "clean_text",              # T8: text cleaning
    "tfidf_long",              # T14: TF-IDF uni+bigrams, 5000 terms
    "knn_predict",             # C3: exact scaled 5-NN
    "split_stratified",        # X2: exact stratified split
    "undersample",             # X1: balanced undersampling
    "class_terms_top",         # T16: per-class term counts
    "silhouette_exact",        # V6: exact silhouette
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    # spark.checkpoint.dir is taken from the session's configuration; get_spark falls back to a temporary
    # folder only when it is unset on a local master
    spark = get_spark(f"local[{cpus}]", app="quarry-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "8g"})
    # warm-up: JVM, Python workers, parquet footers
    QUERIES["value_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in names:
        took = []
        try:
            for _ in range(1 + runs):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                took.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(took[1:]), 3)
        except Exception as e:  # keep measuring the others; report the failure in the JSON line
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {"metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
