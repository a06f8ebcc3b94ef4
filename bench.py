"""Wall time of the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (3 by default); the median counts. A run
builds the plan and computes every row of the result, which goes nowhere.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from workload.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "parse_day_calendar",
    "weather_daily",
    "overall_kpis",
    "festival_category",
    "top_products",
    "geo_summary",
    "weather_sales",
    "unmatched_report",
    "payment_vendor",
    "share_data",
    "corr_matrix",
    "metric_cards",
    "scan_multi_file_key",
    "parquet_partitioned_roundtrip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    line = {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
