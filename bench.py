"""Time headline queries and print one JSON line.

Data folder from BENCH_SF_DIR, local cores from BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "merge_prefer_latest", "build_id_map", "apply_id_map", "keep_common_users", "keep_churn_transition",
    "exclusion_flags", "sessionize_transactions", "add_actual_plan_days", "membership_seq_info",
    "last_txn_in_window", "logs_in_membership", "user_logs_features", "ml_features", "training_pipeline",
    "plan_days_buckets", "cancel_plan_days_report", "cancel_streak_report", "expire_decrease_report",
    "correlation_pairs", "clip_distribution", "dense_daily_grid", "ffill_transactions", "usage_window_features",
)


def main() -> None:
    from checks import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small run starts the JVM's compiler and the file readers.
    QUERIES["last_txn_in_window"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
