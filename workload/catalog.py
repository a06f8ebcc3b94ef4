"""One named query per operator or plan, each over whole tables of the driver's data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marigold.functions.bands import HUMIDITY, TEMPERATURE, band
from marigold.functions.text import items_as_text, key_in_path
from marigold.operators import explore
from marigold.operators.checks import require
from marigold.operators.enrich import MATCHED, enrich
from marigold.operators.ranking import collect_top, top_items, top_label
from marigold.operators.summarize import Measures, summarize, totals
from marigold.plans import jobs, masters, summaries
from marigold.sources.files import chosen_paths, keep_listed, list_files, match_names, with_file_key
from marigold.sources.schemas import weather as weather_schema
from marigold.sources.sinks import export_csv as write_csv, write_parquet, write_table
from marigold.sources.tables import read_csv, read_parquet, uri
from marigold.staging import scratch_path

from workload.job_catalog import FIRST_KEYS, JOB_QUERIES
from workload.star import MONEY_DIGITS, READING_DIGITS, readings, sales, table

Query = Callable[[SparkSession, str], DataFrame]

SALE_INPUTS = ("revenue_INR", "units_sold", "price_INR")
FESTIVAL_YEAR = ["festival", "year"]
CITY_YEAR = ["state", "city", "year"]
CORRELATED = ("revenue_INR", "units_sold", "price_INR", "discount_pct", "seller_rating")

# Where the key sits in a family of files that Spark wrote, one folder per city.
CITY_FOLDER = r"city=([^/]+)/[^/]+\.csv$"
# Where the table name sits in the path of a Parquet table, be it a file or a folder of part files.
TABLE_STEM = r"([^/]+)\.parquet(?:/[^/]+)?$"


# --- sources and sinks -------------------------------------------------------------------------------


def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "dd-MM-yyyy").alias("order_day")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", day)
    path = scratch_path(spark, "orders.csv")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_tax")
    raw, target = scratch_path(spark, "lines.csv"), scratch_path(spark, "lines")
    write_csv(lines, raw)
    write_parquet(read_csv(spark, raw, lines.schema), target)
    return read_parquet(spark, target)


def _city_files(spark: SparkSession, sf_dir: str) -> str:
    """The readings as CSV files without a city column, in one folder per city."""
    path = scratch_path(spark, "readings")
    hourly = readings(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    write_table(hourly, path, "csv", partition_by=["city"])
    return path


def scan_multi_file_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = read_csv(spark, uri(_city_files(spark, sf_dir), "*/*.csv"), weather_schema())
    keyed = with_file_key(scan, "city", CITY_FOLDER)
    measures = Measures(sums={"total_precip_mm": "precipitation"}, rows="readings", minor_digits=READING_DIGITS)
    return summarize(keyed, ["city"], measures)


def weather_daily_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = read_csv(spark, uri(_city_files(spark, sf_dir), "*/*.csv"), weather_schema())
    return masters.weather_daily(with_file_key(scan, "city", CITY_FOLDER), minor_digits=READING_DIGITS)


def scan_tables_by_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = T.StructType([T.StructField("text", T.StringType())])
    scan = spark.read.schema(text).option("recursiveFileLookup", True).parquet(sf_dir)
    return with_file_key(scan, "table_name", TABLE_STEM).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("text").alias("n_texts")
    )


def _city_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City names as people type them: padded, with blanks for underscores, each twice."""
    nations = table(spark, sf_dir, "nation")
    typed = F.concat(F.lit("  "), F.replace("n_name", F.lit("_"), F.lit(" ")), F.lit(" "))
    return nations.select(typed.alias("City Name")).union(nations.select("n_name")).union(nations.select(F.lit("  ")))


def select_files_by_name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, _city_files(spark, sf_dir), (".csv",))
    keyed = files.withColumn("key", key_in_path(F.col("path"), CITY_FOLDER))
    chosen = match_names(_city_list(spark, sf_dir), "City Name", keyed, "key", "path")
    scan = with_file_key(read_csv(spark, chosen_paths(chosen), weather_schema()), "key", CITY_FOLDER)
    counts = scan.groupBy("key").agg(F.count(F.lit(1)).alias("readings"))
    wanted = chosen.select("name", "key").distinct()
    return wanted.join(counts, "key", "left").select("name", F.col("key").isNotNull().alias("found"), "readings")


def _listed_readings(spark: SparkSession, sf_dir: str, listed: bool) -> DataFrame:
    """Readings per city, for cities that are on the list of nations in even regions, or are not."""
    names = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") % 2 == 0)
    names = names.select(F.replace("n_name", F.lit("_"), F.lit(" ")).alias("City Name"))
    kept = keep_listed(readings(spark, sf_dir), "city", names, "City Name", listed)
    return kept.groupBy("city").agg(F.count(F.lit(1)).alias("readings"))


def rows_on_name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed_readings(spark, sf_dir, True)


def rows_not_on_name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed_readings(spark, sf_dir, False)


def list_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables below a folder, with the rows that are in them."""
    listed = list_files(spark, sf_dir).select(key_in_path(F.col("path"), TABLE_STEM).alias("table_name")).distinct()
    return listed.join(scan_tables_by_file_name(spark, sf_dir).select("table_name", "n_rows"), "table_name", "left")


def parquet_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "product_id", "festival_date", "year", "month", "units_sold", "revenue_INR")
    path = scratch_path(spark, "sales")
    write_parquet(rows, path, ["year", "month"])
    back = read_parquet(spark, path)
    return back.select("product_id", "festival_date", "year", "month", "units_sold", F.col("revenue_INR").alias("revenue"))


def parquet_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_state = summarize(sales(spark, sf_dir, "state", "year", "units_sold"), ["state", "year"], Measures(sums={"total_units": "units_sold"}))
    path = scratch_path(spark, "states")
    write_parquet(by_state, path, ["state", "year"])
    return read_parquet(spark, path, {"state": "string", "year": "int"})


def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = payment_vendor(spark, sf_dir)
    path = scratch_path(spark, "filtered.csv")
    write_csv(explore.filter_values(summary, "vendor_type", ["BUILDING", "MACHINERY"]), path)
    return read_csv(spark, path, summary.schema)


# --- masters -----------------------------------------------------------------------------------------


def _typed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their day as text; every seventh is written in another format and does not parse."""
    other = F.date_format("o_orderdate", "yyyy/MM/dd")
    text = F.when(F.col("o_orderkey") % 7 == 0, other).otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("festival_date"))


def parse_day_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masters.products(_typed_days(spark, sf_dir))


def festival_sales_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masters.festival_sales(_typed_days(spark, sf_dir).withColumnRenamed("festival_date", "Date"))


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masters.weather_daily(readings(spark, sf_dir), minor_digits=READING_DIGITS)


def require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and written, counted by the one write of a checked table."""
    rows = sales(spark, sf_dir, "festival_date", *summaries.DAILY_KPIS.inputs)
    daily = summaries.overall_kpis(require(rows, ["festival_date", *SALE_INPUTS], "sales"), MONEY_DIGITS)
    path = scratch_path(spark, "kpis")
    written = write_parquet(daily, path, ["year", "month"], metrics={"input_rows": F.sum("total_tx")})
    report = [("overall_kpis", written.metrics["input_rows"], written.rows)]
    return spark.createDataFrame(report, "plan string, input_rows bigint, output_rows bigint")


# --- summaries ---------------------------------------------------------------------------------------


def overall_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.overall_kpis(sales(spark, sf_dir, "festival_date", *summaries.DAILY_KPIS.inputs), MONEY_DIGITS)


def _festival_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, *FESTIVAL_YEAR, "product_category", "product", *SALE_INPUTS)
    return summaries.festival_category_summary(rows, minor_digits=MONEY_DIGITS)


def festival_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _festival_category(spark, sf_dir).withColumn("top_products", items_as_text(F.col("top_products")))


def _top_products(spark: SparkSession, sf_dir: str, measure: str, ties: str = "all") -> DataFrame:
    rows = sales(spark, sf_dir, *FESTIVAL_YEAR, "product", measure)
    return top_items(rows, FESTIVAL_YEAR, "product", measure, summaries.TOP_PRODUCTS, ties, minor_digits=MONEY_DIGITS)


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _top_products(spark, sf_dir, "revenue_INR")
    return top.withColumn("total", F.col("total").cast("double"))


def top_products_by_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_products(spark, sf_dir, "units_sold")


def top_products_first_of_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_products(spark, sf_dir, "units_sold", "first")


def top_products_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _top_products(spark, sf_dir, "revenue_INR")
    nested = collect_top(top, FESTIVAL_YEAR, "product", "total", "top_products", "revenue")
    rows = nested.select(*FESTIVAL_YEAR, F.posexplode("top_products").alias("place", "entry"))
    return rows.select(*FESTIVAL_YEAR, "place", "entry.product", "entry.revenue")


def geo_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, *CITY_YEAR, "latitude", "longitude", "product_category", *SALE_INPUTS)
    return summaries.geo_summary(rows, minor_digits=MONEY_DIGITS)


def top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, *CITY_YEAR, "product_category", "revenue_INR")
    per_category = totals(rows, [*CITY_YEAR, "product_category"], "revenue_INR", "revenue", MONEY_DIGITS)
    return top_label(per_category, CITY_YEAR, "product_category", "revenue", "top_category")


def payment_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "vendor_type", "payment_methods", "year", *summaries.VENDOR.inputs)
    return summaries.payment_vendor_summary(rows, MONEY_DIGITS)


# --- the jobs a user submits: masters in, written summary read back ----------------------------------


def _layout(spark: SparkSession, sf_dir: str, *columns: str) -> jobs.Layout:
    """The products master, with money as decimals, in a layout of its own."""
    layout = jobs.Layout(scratch_path(spark, "job"))
    rows = sales(spark, sf_dir, *dict.fromkeys(["year", "month", *columns]))
    money = [c for c in ("revenue_INR", "price_INR", "seller_rating") if c in rows.columns]
    write_parquet(rows.withColumns({c: F.col(c).cast("decimal(18,2)") for c in money}), layout.master("products"), ["year", "month"])
    return layout


def job_overall_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark, sf_dir, "festival_date", *summaries.DAILY_KPIS.inputs)
    jobs.run_overall_kpis(spark, layout)
    return read_parquet(spark, layout.summary("overall_kpis"))


def job_festival_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark, sf_dir, "festival", "product_category", "product", *SALE_INPUTS)
    jobs.run_festival_category_summary(spark, layout)
    return explore.readable(read_parquet(spark, layout.summary("festival_category_summary")))


def job_geo_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark, sf_dir, "state", "city", "latitude", "longitude", "product_category", *SALE_INPUTS)
    jobs.run_geo_summary(spark, layout)
    return read_parquet(spark, layout.summary("geo_summary"))


def job_payment_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark, sf_dir, "vendor_type", "payment_methods", *summaries.VENDOR.inputs)
    jobs.run_payment_vendor_summary(spark, layout)
    return read_parquet(spark, layout.summary("payment_vendor_summary"))


def job_weather_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = jobs.Layout(scratch_path(spark, "job"))
    rows = sales(spark, sf_dir, "city", "sale_day", "year", "month", *SALE_INPUTS).withColumnRenamed("sale_day", "festival_date")
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("revenue_INR", "price_INR")}
    write_parquet(rows.withColumns(money), layout.master("products"), ["year", "month"])
    write_parquet(weather_daily(spark, sf_dir), layout.master("weather_daily"), ["year", "month"])
    jobs.run_weather_sales_summary(spark, layout)
    return read_parquet(spark, layout.summary("weather_sales_summary"))


# --- sales and weather -------------------------------------------------------------------------------


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "city", "sale_day", *SALE_INPUTS)
    return summaries.sales_days_with_weather(rows, weather_daily(spark, sf_dir), "sale_day", MONEY_DIGITS)


def weather_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.weather_sales_from_days(_days(spark, sf_dir))


def weather_sales_unknown_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.weather_sales_from_days(_days(spark, sf_dir), unknown_label="unknown")


def enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale row with the weather of its city and day."""
    rows = sales(spark, sf_dir, "product_id", "city", "sale_day", "units_sold")
    joined = enrich(rows, weather_daily(spark, sf_dir), {"city": "city", "sale_day": "date"}, ["avg_temp_C", "total_precip_mm"])
    return joined.withColumn("matched", F.col(MATCHED).isNotNull()).drop(MATCHED)


def unmatched_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.unmatched_report(_days(spark, sf_dir))


def unmatched_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with a threshold that the unmatched 31st passes."""
    return summaries.unmatched_report(_days(spark, sf_dir), threshold=0.01)


def unmatched_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.unmatched_days_sample(_days(spark, sf_dir))


def band_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = band(F.col("temperature_2m"), TEMPERATURE).alias("temp_bucket")
    return readings(spark, sf_dir).groupBy("city", label).agg(F.count(F.lit(1)).alias("readings"))


def band_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = band(F.col("relative_humidity_2m"), HUMIDITY).alias("humidity_bucket")
    return readings(spark, sf_dir).groupBy("city", label).agg(F.count(F.lit(1)).alias("readings"))


# --- exploration -------------------------------------------------------------------------------------


def inspect_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of every table of the folder, with the first three values of each column, as one plan."""
    values = explore.first_values({name: table(spark, sf_dir, name) for name in FIRST_KEYS}, FIRST_KEYS)
    ordered = F.sort_array(F.collect_list(F.when(F.col("row_number").isNotNull(), F.struct("row_number", "value"))))
    shown = F.transform(ordered, lambda entry: entry["value"]).alias("first_values")
    return values.groupBy("table_name", "position", "column_name", "column_type").agg(shown)


def preview_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = _festival_category(spark, sf_dir)
    return explore.preview(summary.orderBy("festival", "year", "product_category"), 500)


def preview_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 500 of more days."""
    return explore.preview(overall_kpis(spark, sf_dir).orderBy("date"), 500)


def metric_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.metric_cards(overall_kpis(spark, sf_dir))


def bar_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "product_category", "festival", "revenue_INR")
    return explore.bar_data(rows, "product_category", "revenue_INR", "festival", MONEY_DIGITS)


def share_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "vendor_type", "revenue_INR")
    return explore.share_data(rows, "vendor_type", "revenue_INR", minor_digits=MONEY_DIGITS)


def line_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather_daily(spark, sf_dir)
    return explore.line_data(rows, "date", "avg_temp_C", "city")


def scatter_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "units_sold", "discount_pct", "festival")
    return explore.scatter_data(rows, "units_sold", "discount_pct", "festival")


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = explore.corr_matrix(sales(spark, sf_dir, *CORRELATED), CORRELATED)
    return cells.withColumn("r", F.round("r", 6))


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.distinct_values(sales(spark, sf_dir, "product_category"), "product_category")


def filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "product_id", "product_category", "festival_date", "units_sold")
    return explore.filter_values(rows, "product_category")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_csv_roundtrip, csv_to_parquet, scan_multi_file_key, weather_daily_from_files, scan_tables_by_file_name,
        select_files_by_name_list, rows_on_name_list, rows_not_on_name_list, list_datasets, parquet_partitioned_roundtrip,
        parquet_state_roundtrip, export_csv, parse_day_calendar, festival_sales_master, weather_daily,
        require_columns, overall_kpis, festival_category, top_products, top_products_by_units,
        top_products_first_of_ties, top_products_nested, geo_summary, top_category, payment_vendor, job_overall_kpis,
        job_festival_category, job_geo_summary, job_payment_vendor, job_weather_sales, weather_sales,
        weather_sales_unknown_band, enriched_sales, unmatched_report, unmatched_alarm, unmatched_sample, band_temperature,
        band_humidity, inspect_columns, preview_text, preview_daily, metric_cards, bar_data, share_data, line_data, scatter_data,
        corr_matrix, distinct_values, filter_values,
    )
} | JOB_QUERIES
