"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (3 unless set); the median counts.
Results go to the noop sink, so the whole plan runs and nothing is kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monitoring_append", "monitoring_increment", "truth_backfill", "regression_metrics",
    "monitoring_quality_5min", "monitoring_profile_5min", "profile_snapshot", "mae_alert",
    "monitoring_drift_baseline", "monitoring_drift_prev_window", "endpoint_usage",
    "booking_clean", "booking_split_counts", "category_encode", "feature_training_set", "ab_outcome",
    "change_feed", "constraint_violations", "chunk_table", "document_elements", "word_count_eval",
    "knn_cosine", "bm25_topk", "hybrid_rrf", "rerank_overlap", "session_history", "session_rebuild",
    "trace_rollup", "trace_minute_series", "trace_performance_review", "metric_last_best", "cost_by_sku",
]
ONCE = ["stream_profile", "gbt_scores"]  # jobs that write or train: timed in one run


def main() -> None:
    from tidewheel.plans import catalogue
    from tidewheel.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE + ONCE
    spark = build_session("bench", cpus)
    known, times = catalogue.queries(), {}
    for name in wanted:
        samples = []
        for i in range(1 if name in ONCE else runs + 1):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - start)
        times[name] = round(statistics.median(samples[1:] or samples), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "sum of median query seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
