"""Ways to add up one money column, grouped by two keys: nanoseconds per row and core; prints one JSON line.

The rows are the line items at ``BENCH_SF_DIR``, each ``BENCH_COPIES`` times. This is the measurement behind
``marigold.functions.exact``: sums of decimals are exact and slow, sums of doubles fast and dependent on their order.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marigold.operators.summarize import Measures, preaggregate  # noqa: E402
from marigold.staging import scratch_path  # noqa: E402

KEYS = ["l_returnflag", "l_linestatus"]


def main() -> None:
    sf_dir, copies = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_COPIES", "40"))
    cpus, runs = int(os.environ.get("BENCH_CPUS", "8")), int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench sums").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*KEYS, F.col("l_extendedprice").alias("d"), F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("col")
    path = scratch_path(spark, "sums")
    lines.repartition(cpus * 4).withColumns({"m": F.col("d").cast("decimal(18,2)"), "s": F.col("d").cast("decimal(15,2)")}).write.parquet(path)
    rows = spark.read.parquet(path)
    n = rows.count()
    ways = {
        "double": lambda: rows.groupBy(*KEYS).agg(F.sum("d")),
        "exact from double": lambda: preaggregate(rows, KEYS, Measures(sums={"t": "d"}, minor_digits=2)),
        "exact from decimal(18,2)": lambda: preaggregate(rows, KEYS, Measures(sums={"t": "m"})),
        "decimal(18,2)": lambda: rows.groupBy(*KEYS).agg(F.sum("m")),
        "decimal(15,2)": lambda: rows.groupBy(*KEYS).agg(F.sum("s")),
    }
    best = {}
    for name, way in ways.items():
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            way().collect()
            taken.append(time.perf_counter() - start)
        best[name] = round(min(taken[1:]) * cpus / n * 1e9)
    spark.stop()
    print(json.dumps({"metric": "sums", "unit": "ns per row and core", "rows": n, "ways": best}))


if __name__ == "__main__":
    main()
