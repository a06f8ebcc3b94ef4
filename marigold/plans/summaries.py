"""The five summaries over the product transactions, and the match report of sales and weather.

Each is a lazy plan over masters. Where a summary needs two aggregates of the fact table, both are rolled up from
one pre-aggregate, which jobs stage so that the fact is scanned and shuffled once.

Money that is stored as decimal adds up exactly. For money that is stored as double, ``minor_digits`` says how
many decimal digits it has and makes its totals exact too; without it doubles are added as they are.

``rows`` names a further column: how many input rows each output row stands for, so that the sum over the output is the
number of rows that were read. Jobs observe it with their write.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from marigold.functions.bands import HUMIDITY, TEMPERATURE, band, positive_flag
from marigold.functions.calendar import with_calendar
from marigold.operators.checks import DAY, NUMBER, require
from marigold.operators.enrich import enrich, match_report, unmatched_sample
from marigold.operators.ranking import bounded_top, collect_top, keep_top, top_label
from marigold.operators.summarize import Measures, preaggregate, reported, roll_up, summarize, total_of

TOP_PRODUCTS = 5
UNMATCHED_ALARM = 0.05
SAMPLE_ROWS = 10

SALES = Measures(
    sums={"total_revenue": "revenue_INR", "total_units": "units_sold"},
    means={"avg_price": "price_INR"},
)
DAILY_KPIS = Measures(
    sums=SALES.sums,
    rows="total_tx",
    means={**SALES.means, "avg_discount": "discount_pct", "avg_seller_rating": "seller_rating"},
)
VENDOR = Measures(sums=SALES.sums, means={"avg_discount": "discount_pct"})
SALES_AND_ROWS = Measures(sums=SALES.sums, means=SALES.means, rows="sale_rows")

Share = Callable[[DataFrame], DataFrame]


def overall_kpis(sales: DataFrame, minor_digits: int | None = None) -> DataFrame:
    """Revenue, units, transactions and mean price, discount and rating per day."""
    require(sales, {"festival_date": None, **dict.fromkeys(DAILY_KPIS.inputs, NUMBER)}, "products")
    dated = sales.withColumn("date", F.col("festival_date").cast("date"))
    daily = summarize(dated, ["date"], replace(DAILY_KPIS, minor_digits=minor_digits))
    return with_calendar(daily, "date")


def _named(keys: list[str]) -> Column:
    """Rows whose group a join can find again: no key is null."""
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


FESTIVAL_KEYS = ["festival", "product_category", "year"]
PLACE_KEYS = ["state", "city", "latitude", "longitude", "year"]


def festival_fine(sales: DataFrame, minor_digits: int | None = None, more: Sequence[str] = ()) -> DataFrame:
    """The pre-aggregate behind ``festival_category_summary``: one state row per product of each category."""
    keys = [*FESTIVAL_KEYS, "product", *more]
    require(sales, {**dict.fromkeys(keys), **dict.fromkeys(SALES.inputs, NUMBER)}, "products")
    return preaggregate(sales, keys, replace(SALES_AND_ROWS, minor_digits=minor_digits))


def festival_category_summary(
    sales: DataFrame,
    n: int = TOP_PRODUCTS,
    ties: str = "all",
    share: Share = lambda df: df,
    minor_digits: int | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Totals per festival, category and year, each with the top products of its festival and year.

    The plan is lazy, so that filters on it reach the scan; it evaluates the pre-aggregate twice. A job passes a
    ``share`` that writes it once.
    """
    return festival_category_from_fine(share(festival_fine(sales, minor_digits)), n, ties, rows)


def festival_category_from_fine(fine: DataFrame, n: int = TOP_PRODUCTS, ties: str = "all", rows: str | None = None) -> DataFrame:
    """The summary from state rows of products.

    With ``ties="bounded"`` a list never holds more than ``n`` products, and ``more_ties`` says how many others have
    the total of a listed one's rank; the other rules keep or drop them as ``keep_top`` says.
    """
    group = ["festival", "year"]
    per_category = reported(roll_up(fine, FESTIVAL_KEYS), FESTIVAL_KEYS, replace(SALES, rows=rows))
    revenue = total_of(fine, "revenue_INR", F.sum)
    per_product = fine.filter(_named(group)).groupBy(*group, "product").agg(revenue.alias("product_revenue"))
    if ties == "bounded":
        lists = bounded_top(per_product, group, "product", "product_revenue", n, "top_products", "revenue")
    else:
        top = keep_top(per_product, group, "product", "product_revenue", n, ties)
        lists = collect_top(top, group, "product", "product_revenue", "top_products", "revenue")
    return per_category.join(lists, group, "left")


def geo_fine(sales: DataFrame, minor_digits: int | None = None, more: Sequence[str] = ()) -> DataFrame:
    """The pre-aggregate behind ``geo_summary``: one state row per category of each place."""
    keys = [*PLACE_KEYS, "product_category", *more]
    require(sales, {**dict.fromkeys(keys), **dict.fromkeys(SALES.inputs, NUMBER)}, "products")
    return preaggregate(sales, keys, replace(SALES_AND_ROWS, minor_digits=minor_digits))


def geo_summary(
    sales: DataFrame, ties: str = "all", share: Share = lambda df: df, minor_digits: int | None = None, rows: str | None = None
) -> DataFrame:
    """Totals per place and year with the category that sells best in the city.

    Tied best categories give one row each, with the totals repeated, unless ``ties="first"``.
    """
    return geo_from_fine(share(geo_fine(sales, minor_digits)), ties, rows)


def geo_from_fine(fine: DataFrame, ties: str = "all", rows: str | None = None) -> DataFrame:
    """The summary from state rows of categories. Where ties repeat a place, its first row stands for the input rows."""
    group = ["state", "city", "year"]
    per_place = reported(roll_up(fine, PLACE_KEYS), PLACE_KEYS, replace(SALES, rows=rows))
    revenue = total_of(fine, "revenue_INR", F.sum)
    per_category = fine.filter(_named(group)).groupBy(*group, "product_category").agg(revenue.alias("category_revenue"))
    best = top_label(per_category, group, "product_category", "category_revenue", "top_category", ties)
    if rows is None:
        return per_place.join(best, group, "left")
    place = F.row_number().over(Window.partitionBy(*group).orderBy("top_category"))
    joined = per_place.join(best.withColumn("__place", place), group, "left")
    return joined.withColumn(rows, F.when(F.coalesce("__place", F.lit(1)) == 1, F.col(rows)).otherwise(0)).drop("__place")


VENDOR_KEYS = ["vendor_type", "payment_methods", "year"]


def payment_vendor_summary(sales: DataFrame, minor_digits: int | None = None, rows: str | None = None) -> DataFrame:
    """Totals and mean discount per vendor type, payment methods and year."""
    require(sales, {**dict.fromkeys(VENDOR_KEYS), **dict.fromkeys(VENDOR.inputs, NUMBER)}, "products")
    return summarize(sales, VENDOR_KEYS, replace(VENDOR, minor_digits=minor_digits, rows=rows))


def sales_days_with_weather(
    sales: DataFrame, weather: DataFrame, day: str = "festival_date", minor_digits: int | None = None
) -> DataFrame:
    """Sales reduced to one state row per city and day, left-joined with the weather of that city and day.

    Aggregating first turns a join of two fact-sized tables into one of two calendar-sized ones: the only
    shuffle of sales is the map-side combined one, which a hot city or a null key cannot overload. The
    weather is joined on the partitioning that the aggregate already has.
    """
    measures = ["avg_temp_C", "avg_humidity_pct", "total_precip_mm"]
    require(sales, {"city": None, day: DAY, **dict.fromkeys(SALES.inputs, NUMBER)}, "products")
    require(weather, {"city": None, "date": DAY, **dict.fromkeys(measures, NUMBER)}, "weather")
    dated = sales.withColumn("join_date", F.col(day).cast("date"))
    days = preaggregate(dated, ["city", "join_date"], replace(SALES_AND_ROWS, minor_digits=minor_digits))
    readings = weather.withColumn("weather_date", F.col("date").cast("date"))
    return enrich(days, readings, {"city": "city", "join_date": "weather_date"}, measures)


def weather_sales_from_days(days: DataFrame, unknown_label: str | None = None, rows: str | None = None) -> DataFrame:
    """Totals per city, day and weather bands from the rows of ``sales_days_with_weather``.

    The grouping keys contain the join keys, so the rows already lie where they are needed.
    """
    keys = ["city", "date", "year", "month", "temp_bucket", "humidity_bucket", "rain_flag"]
    banded = with_calendar(days.withColumnRenamed("join_date", "date"), "date", ["year", "month"]).withColumns(
        {
            "temp_bucket": band(F.col("avg_temp_C"), TEMPERATURE, unknown_label),
            "humidity_bucket": band(F.col("avg_humidity_pct"), HUMIDITY, unknown_label),
            "rain_flag": positive_flag(F.col("total_precip_mm")),
        }
    )
    return reported(roll_up(banded, keys), keys, replace(SALES, rows=rows))


def weather_sales_summary(
    sales: DataFrame,
    weather: DataFrame,
    day: str = "festival_date",
    unknown_label: str | None = None,
    minor_digits: int | None = None,
) -> DataFrame:
    """Totals per city, day and weather bands. Sales without weather fall in the last bands, without rain."""
    days = sales_days_with_weather(sales, weather, day, minor_digits)
    return weather_sales_from_days(days, unknown_label)


def unmatched_report(days: DataFrame, threshold: float = UNMATCHED_ALARM) -> DataFrame:
    """One row on the sale rows that found no weather, from the rows of ``sales_days_with_weather``."""
    return match_report(days, "avg_temp_C", "__rows", threshold)


def unmatched_days_sample(days: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """City and day of the first ``n`` sale rows without weather."""
    return unmatched_sample(days, ["city", "join_date"], "avg_temp_C", n, "__rows")
