"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run into the noop sink: one warm-up, then the median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pulseframe.catalog import all_queries
from pulseframe.session import local_session

HEADLINE = (
    "samples_flat", "telemetry_documents", "cleaned_samples", "sliding_windows", "features_all_windows",
    "features_all_events", "ground_truth_dataset", "exclusion_ledger", "session_windows", "validate_frame_order",
    "validate_batch_gaps", "qa_describe", "parity_summary", "group_split_user", "roc_auc", "best_f1_threshold",
    "stream_sliding_features",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "bench")
    registered, seconds = all_queries(), {}
    for name in names:
        def once() -> float:
            start = time.perf_counter()
            registered[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        once()
        seconds[name] = round(statistics.median(once() for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
