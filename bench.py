"""Times the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; its time is the median.
Results go to a sink that discards them, so every row and column is produced.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from assayline.checks.queries import QUERIES
from assayline.session import local_session

HEADLINE = (
    "bronze_customers", "bronze_claims", "silver_customers", "silver_cars", "silver_policy",
    "silver_sales", "silver_claims", "quarantine_claims", "quality_log", "reconcile_counts",
    "dedup_latest", "dedup_rejects", "fact_claims", "fact_sales", "rejection_by_region_month",
    "processing_time_by_severity", "unsold_by_model_region", "claim_value_by_region_policy",
    "customer_count_by_region", "kpi_claims", "kpi_policies", "kpi_insights",
    "anomaly_population", "anomaly_scores", "anomaly_report", "cosine_topk", "retrieval_stats",
    "policy_text", "response_text", "stream_dedup", "stream_clean",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, shuffle_partitions=cores, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, sum of median seconds",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
