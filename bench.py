"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from fareloom.plans import registry  # noqa: E402
from fareloom.session import SQL_SETTINGS  # noqa: E402

HEADLINE = (
    "silver_clean", "silver_accounting", "gold_daily", "gold_vendor", "gold_borough", "gold_payment",
    "gold_hourly", "fact_trips", "star_join", "star_rollup_top10", "star_revenue", "bi_dataset",
    "reconciliation", "tie_out_revenue", "profile_missing", "profile_duration", "profile_boxplot",
    "quality_report", "zone_standardise_hash", "scd2_first_load", "scd2_change", "scd2_chain",
    "scd2_audit", "resolve_current", "as_of_zone", "scd1_upsert", "dup_key_listing",
    "dedupe_keep_first", "run_stats", "log_summary", "alarm_windows", "sync_runs",
    "version_diff", "stream_alarm_execution_failed",
)
REPEATS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    queries = registry.queries()
    # One untimed query starts the JVM's worker threads and loads the classes.
    queries["gold_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            # The noop sink computes every row and column without collecting any.
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "median": round(statistics.median(times.values()), 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
