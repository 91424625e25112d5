"""Compare registered queries with their SQL: python tests/run_oracle.py [folder] [name prefix ...]."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import connect, difference  # noqa: E402

from churnlake.catalog import ORACLES, QUERIES  # noqa: E402
from churnlake.session import build_session  # noqa: E402


def main():
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark, con, bad = build_session("local[8]"), connect(directory), 0
    for name in sorted(QUERIES):
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = QUERIES[name](spark, directory)
            problem = difference(df, con, ORACLES[name]) if name in ORACLES else None
            note = "ok" if name in ORACLES else f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        spark.catalog.clearCache()
        bad += problem is not None
        print(f"{name:35s} {time.time() - start:6.2f}s  {problem or note}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
