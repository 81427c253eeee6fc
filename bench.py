"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the directory of tables, BENCH_CPUS the number of local cores.
Each query runs once to warm up and is then timed from building its plan to the last
row written to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from basketlens.checks.queries import all_queries  # noqa: E402

HEADLINE = (
    "r13_customer_features",
    "e2_transactions_profile",
    "e6_old_segment_behavior",
    "e7_old_segment_campaigns",
    "p7_processed_features",
    "c2_kmeans",
    "c9_score_fixed",
    "v4_rates_and_lift",
    "v13_migration_log",
    "x1_segment_health",
    "x2_health_by_quarter",
    "x4_campaign_performance",
    "x7_profile_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
