"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query runs end to end from the raw Parquet tables (materialised
stages are rebuilt on each run), is executed with the ``noop`` sink (full
plan, no result transfer) and timed warm: one untimed run, then the median
of three; the two jobs with models run once.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bankscope.plans import catalog  # noqa: E402
from bankscope.plans.pipeline import clear_cache  # noqa: E402
from bankscope.session import local_session  # noqa: E402

HEADLINE = [
    "tx_features", "scoring_table", "recommendations", "enriched", "customer_mart", "financial_aggregates",
    "time_series", "kpi_clv", "kpi_concentration", "kpi_engagement", "portfolio_metrics",
    "view_v26_churn_by_streak_bucket", "top50_rar",
]
# Run once, without a warm-up: the mart job with KMeans and the scoring job with both models.
JOBS = ["mart_job", "scoring_job_models"]


def run_once(spark, name: str, sf_dir: str) -> float:
    clear_cache()
    t0 = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16)
    names = sys.argv[1:] or HEADLINE + JOBS
    times = {}
    for name in names:
        if name in JOBS:
            times[name] = round(run_once(spark, name, sf_dir), 3)
            continue
        run_once(spark, name, sf_dir)  # warm-up
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(3)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
