"""What Spark makes of the plans: scans, shuffles, pushdown, skew."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marigold.functions.calendar import in_period
from marigold.operators import explore
from marigold.operators.enrich import enrich
from marigold.operators.ranking import top_items
from marigold.plans import summaries
from marigold.sources.files import list_files
from marigold.sources.sinks import write_parquet
from marigold.sources.tables import read_parquet
from marigold.staging import Staging
from workload.catalog import QUERIES
from workload.star import sales, table


def plan_of(df, mode="simple") -> str:
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain(mode)
    return shown.getvalue()


def final_plan(df) -> str:
    """The plan after adaptive execution ran."""
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def master(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("master") / "products")
    write_parquet(sales(spark, "/root/testdata/sf0.001"), path, ["year", "month"])
    return read_parquet(spark, path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_the_plan_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    nodes = ["EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"]
    for node in nodes if name == "corr_matrix" else [*nodes, "InArrow"]:
        assert node not in plan


def test_kpis_scan_the_fact_once_and_shuffle_once(master):
    plan = plan_of(summaries.overall_kpis(master))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    schema = re.search(r"ReadSchema: struct<(.*)", plan).group(1)
    assert "festival_date" in schema and "product" not in schema and "city" not in schema


def test_top_items_are_cut_before_the_group_shuffle(master):
    plan = plan_of(top_items(master, ["festival", "year"], "product", "revenue_INR", 5))
    lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert len(lines) == 4
    assert "Final" in lines[0] and "Exchange hashpartitioning(festival" in lines[1] and "Partial" in lines[2]
    assert re.search(r"hashpartitioning\(festival#\d+, year#\d+, product#\d+", lines[3])


@pytest.mark.parametrize("plan", [summaries.festival_category_summary, summaries.geo_summary])
def test_two_aggregates_share_one_scan_of_the_fact(spark, master, plan):
    with Staging(spark) as share:
        staged = plan(master, share=share)
        shared = plan_of(staged)
        assert all("products" not in line for line in shared.splitlines() if "FileScan" in line)
        assert "WindowGroupLimit" in shared
        lazy = plan(master)
        assert plan_of(lazy).count("FileScan") == 2
        assert sorted(map(str, lazy.collect())) == sorted(map(str, staged.collect()))
    assert not any(Path(path).exists() for path in share.paths)


@pytest.mark.parametrize("plan", [summaries.festival_category_summary, summaries.geo_summary])
def test_a_filter_on_a_summary_prunes_the_scan(master, plan):
    shown = plan_of(plan(master).filter("year = 1996"), "formatted")
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", shown)
    assert len(found) == 2 and all("1996" in filters for filters in found)


def test_weather_summary_shuffles_sales_once_and_already_aggregated(spark, master, sf_dir):
    weather = QUERIES["weather_daily"](spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(summaries.weather_sales_summary(master, weather))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    above, below = "\n".join(lines[:join]), "\n".join(lines[join:])
    assert "Exchange" not in above
    # One shuffle each for sales and weather, both with partial aggregates below.
    assert below.count("Exchange") == 2 and below.count("partial_sum") >= 2


def test_share_reads_its_table_once(master):
    plan = final_plan(explore.share_data(master, "vendor_type", "revenue_INR"))
    assert "ReusedExchange" in plan and "Window" not in plan


def test_cards_are_one_aggregate(master):
    plan = plan_of(explore.metric_cards(master))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_correlations_of_many_columns_are_one_scan(master):
    wide = master.select("*", *[(F.col("units_sold") * i + F.col("discount_pct")).alias(f"more{i}") for i in range(17)])
    plan = plan_of(explore.corr_matrix(wide, ["units_sold", "price_INR", "discount_pct", *[f"more{i}" for i in range(17)]]))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_period_prunes_partitions(master):
    plan = plan_of(in_period(master, "festival_date", date(1996, 2, 1), date(1996, 3, 31), ("year", "month")), "formatted")
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "year" in filters and "month" in filters
    kept = in_period(master, "festival_date", date(1996, 2, 1), date(1997, 3, 31), ("year", "month"))
    expected = master.filter("festival_date between '1996-02-01' and '1997-03-31'")
    assert kept.count() == expected.count() > 0
    assert re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(kept, "formatted")).group(1).count("month") >= 1
    other = in_period(master, "sale_day", date(2024, 1, 1), date(2024, 1, 31))
    assert other.count() == master.count()


def test_chosen_values_reach_the_scan(master):
    plan = plan_of(explore.filter_values(master, "vendor_type", ["BUILDING"]))
    assert "PushedFilters: [IsNotNull(vendor_type), EqualTo(vendor_type,BUILDING)]" in plan


def test_listing_does_not_read_content(spark, sf_dir):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(list_files(spark, sf_dir))).group(1)
    assert "content" not in schema


def test_unneeded_dimensions_are_not_read(spark, sf_dir):
    plan = plan_of(sales(spark, sf_dir, "vendor_type", "payment_methods", "year", "revenue_INR"))
    assert plan.count("FileScan") == 3
    assert plan_of(sales(spark, sf_dir, "units_sold")).count("FileScan") == 1


def test_fact_is_never_the_broadcast_side(spark):
    plan = final_plan(QUERIES["payment_vendor"](spark, "/root/testdata/sf0.01"))
    assert "BuildLeft" not in plan


@pytest.mark.parametrize("child, key, parent, id_", [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey")])
def test_foreign_keys_hold(spark, child, key, parent, id_):
    sf = "/root/testdata/sf0.01"
    children, parents = table(spark, sf, child), table(spark, sf, parent)
    assert children.join(parents, F.col(key) == F.col(id_), "left_anti").count() == 0
    assert parents.select(id_).distinct().count() == parents.count()


def test_hot_key_of_a_row_level_join_is_split(spark):
    """Half of all sales lie in one city and day, a quarter has no city: adaptive execution splits both."""
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 4 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    facts = spark.range(0, 200_000, 1, 16).select(key.alias("city"), F.lit(date(2024, 1, 1)).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    weather = spark.range(0, 200_000, 1, 4).select(F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("city"), F.lit(date(2024, 1, 1)).alias("date"), F.lit(1.0).alias("avg_temp_C"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = enrich(facts, weather, {"city": "city", "day": "date"}, ["avg_temp_C"])
        plan = final_plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in plan
    assert joined.count() == 200_000


def test_hot_group_leaves_the_map_side_aggregated(spark):
    """A city with nearly all sales costs one state row per task and day, not its rows."""
    rows = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("city"), F.lit(date(2024, 1, 1)).alias("festival_date"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("revenue_INR"), F.lit(1).alias("units_sold"), F.lit(Decimal("2.00")).cast("decimal(18,2)").alias("price_INR"))
    weather = spark.createDataFrame([("hot", date(2024, 1, 1), 20.0, 50.0, 0.0)], "city string, date date, avg_temp_C double, avg_humidity_pct double, total_precip_mm double")
    result = {r.city: r for r in summaries.weather_sales_summary(rows, weather).filter("city = 'hot'").collect()}
    assert (result["hot"].total_revenue, result["hot"].total_units, result["hot"].temp_bucket) == (90_000.0, 90_000, "15-25")
