"""Run every registered query at one scale factor and compare with its DuckDB oracle (rows-only when there
is none). Usage: python tests/run_oracle.py [SF_DIR] [query ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402
from quarry.plans.registry import QUERIES, SQL  # noqa: E402
from quarry.session import get_spark  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = QUERIES[n](spark, sf)
            ok, msg = compare(df, con, SQL[n]) if n in SQL else (True, f"rows-only {df.count()}")
        except Exception as e:  # report and continue with the next query
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time() - t:6.1f}s {msg}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
