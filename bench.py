"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then RUNS times; the median counts. Plan building is part of
the time, because some queries checkpoint shared inputs while they are built.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.plans.catalog import QUERIES
from tidemark.session import session_builder

RUNS = 3
HEADLINE = [
    "quarantine_split",
    "silver_financials_clean",
    "lms_mob_dpd",
    "gold_financials",
    "feature_merge_outer",
    "training_set_pit_join",
    "train_test_oot_split",
    "profile_numeric",
    "profile_string",
    "profile_quantiles",
    "correlation_matrix",
    "auc_gini",
    "performance_history",
    "csi_feature_drift",
    "retrain_decision",
    "topk_recent_per_group",
    "carry_forward_unchanged",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        session_builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median seconds, summed over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
