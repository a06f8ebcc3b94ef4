"""Every headline query beside its plain form, timed in one session; prints one JSON line.

``plain`` is what a script would write without this library: averages and sums of doubles, row-level joins, one scan per
aggregate, types inferred from CSV, a chart's correlations on the driver. Both read the star at ``BENCH_SF_DIR`` and
drop their rows in a sink that keeps nothing; each figure is the median of ``BENCH_RUNS`` runs after one to warm up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import HEADLINE  # noqa: E402
from marigold.staging import scratch_path  # noqa: E402
from workload.catalog import QUERIES  # noqa: E402
from workload.star import readings, sales, table  # noqa: E402


def totals() -> list[Column]:
    return [F.sum("revenue_INR").alias("total_revenue"), F.sum("units_sold").alias("total_units"), F.avg("price_INR").alias("avg_price")]


def drop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _calendar(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("year", F.year(day)).withColumn("month", F.month(day)).withColumn("day", F.dayofmonth(day))


def _ranked(df: DataFrame, group: list[str], item: str, n: int) -> DataFrame:
    summed = df.groupBy(*group, item).agg(F.sum("revenue_INR").alias("total"))
    return summed.withColumn("rank", F.rank().over(Window.partitionBy(*group).orderBy(F.col("total").desc()))).filter(F.col("rank") <= n)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).withColumn("day", F.to_date("date"))
    means = [F.avg("temperature_2m").alias("avg_temp_C"), F.avg("relative_humidity_2m").alias("avg_humidity_pct")]
    daily = rows.groupBy("city", "day").agg(*means, F.sum("precipitation").alias("total_precip_mm")).withColumnRenamed("day", "date")
    return _calendar(daily.withColumn("rain_flag", F.col("total_precip_mm") > 0), "date")


def parse_day_calendar(spark: SparkSession, sf_dir: str) -> None:
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy").alias("d"))
    drop(_calendar(text.withColumn("d", F.try_to_date("d", "dd-MM-yyyy")), "d"))


def weather_daily(spark: SparkSession, sf_dir: str) -> None:
    drop(_daily(spark, sf_dir))


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = [F.count("*").alias("total_tx"), F.avg("discount_pct").alias("avg_discount"), F.avg("seller_rating").alias("avg_seller_rating")]
    return _calendar(sales(spark, sf_dir).groupBy(F.col("festival_date").alias("date")).agg(*totals(), *more), "date")


def overall_kpis(spark: SparkSession, sf_dir: str) -> None:
    drop(_kpis(spark, sf_dir))


def festival_category(spark: SparkSession, sf_dir: str) -> None:
    rows = sales(spark, sf_dir)
    top = _ranked(rows, ["festival", "year"], "product", 5).groupBy("festival", "year").agg(F.collect_list(F.struct("product", "total")).alias("top_products"))
    drop(rows.groupBy("festival", "product_category", "year").agg(*totals()).join(top, ["festival", "year"], "left"))


def top_products(spark: SparkSession, sf_dir: str) -> None:
    drop(_ranked(sales(spark, sf_dir), ["festival", "year"], "product", 5))


def geo_summary(spark: SparkSession, sf_dir: str) -> None:
    rows = sales(spark, sf_dir)
    best = _ranked(rows, ["state", "city", "year"], "product_category", 1).drop("total", "rank")
    drop(rows.groupBy("state", "city", "latitude", "longitude", "year").agg(*totals()).join(best, ["state", "city", "year"], "left"))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = _daily(spark, sf_dir).select("city", F.col("date").alias("sale_day"), "avg_temp_C", "avg_humidity_pct", "total_precip_mm")
    return sales(spark, sf_dir).drop("year", "month").join(weather, ["city", "sale_day"], "left")


def weather_sales(spark: SparkSession, sf_dir: str) -> None:
    warm = F.when(F.col("avg_temp_C") < 15, "<15").when(F.col("avg_temp_C") <= 25, "15-25").when(F.col("avg_temp_C") <= 35, "25-35").otherwise(">35")
    damp = F.when(F.col("avg_humidity_pct") < 40, "<40").when(F.col("avg_humidity_pct") <= 70, "40-70").otherwise(">70")
    keys = [F.year("sale_day").alias("year"), F.month("sale_day").alias("month"), warm.alias("warm"), damp.alias("damp"), (F.col("total_precip_mm") > 0).alias("rain")]
    drop(_joined(spark, sf_dir).groupBy("city", "sale_day", *keys).agg(*totals()))


def unmatched_report(spark: SparkSession, sf_dir: str) -> None:
    joined = _joined(spark, sf_dir)
    joined.filter(F.col("avg_temp_C").isNull()).count()
    joined.count()


def payment_vendor(spark: SparkSession, sf_dir: str) -> None:
    drop(sales(spark, sf_dir).groupBy("vendor_type", "payment_methods", "year").agg(*totals()[:2], F.avg("discount_pct").alias("avg_discount")))


def share_data(spark: SparkSession, sf_dir: str) -> None:
    slices = sales(spark, sf_dir).groupBy("vendor_type").agg(F.sum("revenue_INR").alias("revenue_INR"))
    drop(slices.withColumn("share", F.col("revenue_INR") / F.sum("revenue_INR").over(Window.partitionBy())))


def corr_matrix(spark: SparkSession, sf_dir: str) -> None:
    sales(spark, sf_dir, "revenue_INR", "units_sold", "price_INR", "discount_pct", "seller_rating").toPandas().corr()


def metric_cards(spark: SparkSession, sf_dir: str) -> None:
    kpis = _kpis(spark, sf_dir).toPandas()
    for name in ("total_revenue", "total_units", "total_tx", "avg_price"):
        kpis[name].sum(), kpis[name].std()


def scan_multi_file_key(spark: SparkSession, sf_dir: str) -> None:
    path = scratch_path(spark, "plain")
    readings(spark, sf_dir).write.partitionBy("city").option("header", True).csv(path)
    scan = spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/*/*.csv")
    keyed = scan.withColumn("city", F.regexp_extract(F.input_file_name(), r"city=([^/]+)/", 1))
    drop(keyed.groupBy("city").agg(F.sum("precipitation"), F.count("*")))


def parquet_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> None:
    path = scratch_path(spark, "plain")
    columns = ("product_id", "festival_date", "year", "month", "units_sold", "revenue_INR")
    sales(spark, sf_dir, *columns).write.partitionBy("year", "month").parquet(path)
    drop(spark.read.parquet(path))


PLAIN: dict[str, Callable[[SparkSession, str], None]] = {
    run.__name__: run
    for run in (
        parse_day_calendar, weather_daily, overall_kpis, festival_category, top_products, geo_summary, weather_sales, unmatched_report,
        payment_vendor, share_data, corr_matrix, metric_cards, scan_multi_file_key, parquet_partitioned_roundtrip,
    )
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench plain")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, dict[str, float]] = {}
    for name in HEADLINE:
        times: dict[str, list[float]] = {"plain": [], "ours": []}
        for _ in range(runs + 1):
            for shape, run in (("plain", lambda: PLAIN[name](spark, sf_dir)), ("ours", lambda: drop(QUERIES[name](spark, sf_dir)))):
                start = time.perf_counter()
                run()
                times[shape].append(time.perf_counter() - start)
        seconds[name] = {shape: round(statistics.median(taken[1:]), 2) for shape, taken in times.items()}
    spark.stop()
    print(json.dumps({"metric": "plain", "unit": "sec", "sf": Path(sf_dir).name, "queries": seconds}))


if __name__ == "__main__":
    main()
