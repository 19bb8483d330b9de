"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINES = (
    "completeness_profile", "column_profile", "discovered_rules", "numeric_loose", "format_distribution",
    "iqr_fences", "iqr_outlier_counts", "exact_duplicates", "duplicate_texts", "key_duplicates", "cross_product",
    "audit_issues", "fix_cast_numeric", "fix_clip_iqr_events", "fix_impute_mode", "fix_normalize_dates",
    "fix_drop_duplicates", "plan_applied", "events_semantic_duplicate", "events_hot_key", "evaluate_disguisednull",
    "full_run_given_rules",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from registry import load

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tablewright-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = load()[0]
    # Untimed: starts Python workers, loads classes and compiles what all queries share.
    queries["completeness_profile"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(match.group(1)) if match else sf_dir}))


if __name__ == "__main__":
    main()
