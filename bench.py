#!/usr/bin/env python
"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8): one warm-up, then three timed runs; a run
builds the query and executes it fully into the ``noop`` sink (no driver
collect).  Prints ONE JSON line:
  {"metric": ..., "value": <sum of medians>, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # SQL report pack
    "kpi_summary", "monthly_revenue", "category_performance", "segment_analysis",
    "channel_performance", "regional_performance", "top20_customers", "payment_methods",
    # RFM / customer tables
    "rfm_ntile", "rfm_quantile", "customer_360_view", "churn_risk_flag",
    "cohort_first_purchase", "cohort_join_month",
    # ETL and validation on the dirty fixture
    "clean_transactions", "clean_customers", "quality_report",
    # dashboard / BI
    "kpi_customer_weighted", "daily_revenue", "mom_growth", "rfm_histogram",
    # evaluation
    "eval_auc", "stratified_split",
]
# Model jobs: one run each, fitted anew (no warm-up, no repeats).
MODELS = ["segment_gen1", "churn_gen1_scores"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE

    from basketry.plans.registry import forget_models, queries
    from basketry.session import get_session

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    registry = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    for name in [] if sys.argv[1:] else MODELS:
        forget_models()
        times[name] = round(run(name), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
