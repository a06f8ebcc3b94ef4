"""The summaries in two shapes over the same Parquet masters, timed in one session; prints one JSON line.

``naive``: the same operators without the care: input count, output count and write as three actions; row-level join
before the aggregate; two scans for two aggregates. ``ours``: the jobs of this library. Both write Parquet. Masters are written
once per run to a new folder under the shared folder, from the star at ``BENCH_SF_DIR``; ``BENCH_COPIES`` repeats
every sale that many times, to see how the shapes grow.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marigold.operators.enrich import enrich, match_report  # noqa: E402
from marigold.operators.summarize import preaggregate  # noqa: E402
from marigold.plans import jobs, masters, summaries  # noqa: E402
from marigold.sources.sinks import write_parquet  # noqa: E402
from marigold.staging import scratch_path  # noqa: E402
from workload.star import READING_DIGITS, readings, sales  # noqa: E402


def _counted(name: str, source: DataFrame, plan: DataFrame, target: str) -> None:
    """Input count, output count and write, each evaluating the plan again."""
    source.count()
    plan.count()
    write_parquet(plan, target, jobs.PARTITIONS[name])


def naive_kpis(products: DataFrame, weather: DataFrame, target: str) -> None:
    _counted("overall_kpis", products, summaries.overall_kpis(products), target)


def naive_festival(products: DataFrame, weather: DataFrame, target: str) -> None:
    _counted("festival_category_summary", products, summaries.festival_category_summary(products), target)


def naive_geo(products: DataFrame, weather: DataFrame, target: str) -> None:
    _counted("geo_summary", products, summaries.geo_summary(products), target)


def naive_vendor(products: DataFrame, weather: DataFrame, target: str) -> None:
    _counted("payment_vendor_summary", products, summaries.payment_vendor_summary(products), target)


def naive_weather(products: DataFrame, weather: DataFrame, target: str) -> None:
    """Every sale meets its weather before anything is added up."""
    measures = ["avg_temp_C", "avg_humidity_pct", "total_precip_mm"]
    rows = enrich(products, weather, {"city": "city", "festival_date": "date"}, measures)
    match_report(rows, "avg_temp_C").collect()
    states = preaggregate(rows.withColumn("join_date", F.col("festival_date")), ["city", "join_date", *measures], summaries.SALES_AND_ROWS)
    _counted("weather_sales_summary", products, summaries.weather_sales_from_days(states), target)


PAIRS = {
    "overall_kpis": (naive_kpis, jobs.run_overall_kpis),
    "festival_category_summary": (naive_festival, jobs.run_festival_category_summary),
    "geo_summary": (naive_geo, jobs.run_geo_summary),
    "weather_sales_summary": (naive_weather, jobs.run_weather_sales_summary),
    "payment_vendor_summary": (naive_vendor, jobs.run_payment_vendor_summary),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench shapes")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    layout = jobs.Layout(scratch_path(spark, "shapes"))
    money = {name: F.col(name).cast("decimal(18,2)") for name in ("revenue_INR", "price_INR")}
    rows = sales(spark, sf_dir).drop("festival_date").withColumnRenamed("sale_day", "festival_date").withColumns(money)
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("col")
    write_parquet(rows, layout.master("products"), ["year", "month"])
    write_parquet(masters.weather_daily(readings(spark, sf_dir), minor_digits=READING_DIGITS), layout.master("weather_daily"), ["year", "month"])

    seconds: dict[str, dict[str, float]] = {}
    for name, (naive, ours) in PAIRS.items():
        shapes = {
            "naive": lambda: naive(spark.read.parquet(layout.master("products")), spark.read.parquet(layout.master("weather_daily")), layout.summary(f"naive_{name}")),
            "ours": lambda: ours(spark, layout),
        }
        times: dict[str, list[float]] = {"naive": [], "ours": []}
        for _ in range(runs + 1):
            for shape, run in shapes.items():
                start = time.perf_counter()
                run()
                times[shape].append(time.perf_counter() - start)
        seconds[name] = {shape: round(statistics.median(measured[1:]), 3) for shape, measured in times.items()}
    spark.stop()
    print(json.dumps({"metric": "shapes", "unit": "sec", "sf": Path(sf_dir).name, "copies": copies, "jobs": seconds}))


if __name__ == "__main__":
    main()
