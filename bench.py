"""Wall-clock of the headline queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnlake.catalog import QUERIES  # noqa: E402
from churnlake.session import build_session  # noqa: E402

HEADLINE = (
    "aud_6_distinct_values", "aud_10_validate_clean", "cln_10_clean", "seg_1_contract_churn", "seg_3_all_segments",
    "seg_6_key_measures", "seg_12_tier_summary", "sta_1_describe", "sta_9_feature_correlation", "sta_12_histogram_by_class",
    "sta_13_density", "fea_16_bi_projection", "enc_4_drop_columns", "spl_1_split", "scl_2_apply", "evl_2_roc_auc",
    "evl_5_threshold_sweep", "prd_9_priority_rank", "prd_12_sorted_predictions", "ml_2_logistic_regression",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(f"local[{os.environ.get('BENCH_CPUS', '8')}]", int(os.environ.get("BENCH_CPUS", "8")))
    QUERIES["cln_10_clean"](spark, directory).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/"))}))


if __name__ == "__main__":
    main()
