"""Queries that go through files and jobs: raw text that does not fit, families of files, refreshes, exploration.

Each writes its inputs from whole tables, runs what a user would run, and reads back what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marigold.functions.text import items_as_text
from marigold.operators import explore
from marigold.operators.ranking import bounded_top
from marigold.operators.summarize import Measures, summarize, totals
from marigold.plans import exploration, jobs, masters, refresh, summaries
from marigold.sources import schemas
from marigold.sources.families import read_family
from marigold.sources.files import list_files
from marigold.sources.mounts import mount
from marigold.sources.sinks import export_csv, write_parquet, write_table
from marigold.sources.tables import if_exists, read_csv, read_parquet, read_table, uri
from marigold.sources.typed import infer_schema, typed
from marigold.staging import scratch_path

from workload.star import MONEY_DIGITS, READING_DIGITS, readings, sales, table

Query = Callable[[SparkSession, str], DataFrame]

MONEY = ("revenue_INR", "price_INR", "seller_rating")
SALE_INPUTS = ("revenue_INR", "units_sold", "price_INR")
FESTIVAL_YEAR = ["festival", "year"]
CITY_FOLDER = r"city=([^/]+)/[^/]+\.csv$"
PART_SCHEMA = "l_orderkey long, l_linenumber int, price decimal(18,2), quantity int, tax double"
# Text of whole fact tables is written packed: a file for each task, so that tasks read it as they wrote it.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
CHANGED_YEAR = 1995


def _layout(spark: SparkSession) -> jobs.Layout:
    return jobs.Layout(scratch_path(spark, "job"))


# --- text that does not fit --------------------------------------------------------------------------


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text: prices with a third digit, powers of ten, words and blanks; quantities with a fraction or too large."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    by_order, by_line = F.col("l_orderkey") % 11, F.col("l_linenumber") % 5
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(by_order == 0, F.concat(price, F.lit("5"))).when(by_order == 1, "1e20").when(by_order == 2, "x").when(by_order == 3, " ").otherwise(price).alias("price"),
        F.when(by_line == 0, F.concat(quantity, F.lit(".0"))).when(by_line == 1, F.concat(quantity, F.lit(".7"))).when(by_line == 2, "99999999999").otherwise(quantity).alias("quantity"),
        F.when(by_order == 4, "1d").otherwise(F.col("l_tax").cast("string")).alias("tax"),
    )


def _typed_job(spark: SparkSession, sf_dir: str) -> tuple[jobs.Layout, jobs.JobReport]:
    layout = _layout(spark)
    export_csv(_damaged_lines(spark, sf_dir), layout.raw("lines.csv"))
    schema = spark.createDataFrame([], PART_SCHEMA).schema
    return layout, jobs.csv_to_parquet(spark, layout, "lines.csv", "lines", schema)


def job_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, _ = _typed_job(spark, sf_dir)
    return read_parquet(spark, layout.raw("lines"))


def job_typed_csv_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per column: values that failed and that were rounded, as the write observed them."""
    _, report = _typed_job(spark, sf_dir)
    rows = [(column, counts.get("failed", 0), counts.get("rounded", 0)) for column, counts in report.findings["faults"].items()]
    return spark.createDataFrame(rows, "column_name string, failed long, rounded long")


def job_typed_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, _ = _typed_job(spark, sf_dir)
    rows = read_parquet(spark, layout.debug("quarantine/lines")).select("l_orderkey", "l_linenumber", F.explode("faults").alias("entry"))
    return rows.select("l_orderkey", "l_linenumber", F.col("entry.column").alias("column_name"), "entry.text", "entry.fault")


def _plain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date").alias("order_day")
    code = F.format_string("%03d", F.col("o_custkey") % 1000).alias("code")
    big = (F.col("o_orderkey") + 5_000_000_000).alias("big_key")
    return table(spark, sf_dir, "orders").select("o_orderkey", big, "o_orderpriority", "o_totalprice", day, F.col("o_orderdate").alias("ordered_at"), code, F.expr("o_orderstatus = 'F'").alias("is_final"))


def job_inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as text and converted with the types that were read off them on the way."""
    layout = _layout(spark)
    export_csv(_plain_orders(spark, sf_dir), layout.raw("orders.csv"))
    jobs.csv_to_parquet(spark, layout, "orders.csv", "orders")
    return read_parquet(spark, layout.raw("orders"))


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types read off orders and line items, with decimals."""
    found = []
    for name, rows in (("orders", _plain_orders(spark, sf_dir)), ("lineitem", table(spark, sf_dir, "lineitem"))):
        path = scratch_path(spark, f"{name}.csv")
        export_csv(rows, path)
        raw = read_csv(spark, path)
        found += [(name, f.name, f.dataType.typeName()) for f in infer_schema(raw, decimals=True)]
    return spark.createDataFrame(found, "table_name string, column_name string, kind string")


# --- city files --------------------------------------------------------------------------------------


def _reading_text(spark: SparkSession, sf_dir: str, bad: bool = False) -> DataFrame:
    """Readings as text. ``bad`` spoils the time of every thirteenth event and the temperature of every seventeenth."""
    rows = readings(spark, sf_dir, "event_id")
    at = F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    warm = F.col("temperature_2m").cast("string")
    if bad:
        at = F.when(F.col("event_id") % 13 == 0, "nonsense").otherwise(at)
        warm = F.when(F.col("event_id") % 17 == 0, "cold").otherwise(warm)
    return rows.withColumns({"date": at, "temperature_2m": warm}).drop("event_id")


def _city_layout(spark: SparkSession, rows: DataFrame) -> jobs.Layout:
    layout = _layout(spark)
    write_table(rows, layout.raw("cities"), "csv", partition_by=["city"])
    return layout


def _weather_job(spark: SparkSession, sf_dir: str) -> tuple[jobs.Layout, jobs.JobReport]:
    layout = _city_layout(spark, _reading_text(spark, sf_dir, bad=True))
    return layout, jobs.build_weather_daily(spark, layout, source="cities/*/*.csv", pattern=CITY_FOLDER, digits=READING_DIGITS)


def job_weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather master from files with bad times and temperatures: bad times make no row."""
    layout, _ = _weather_job(spark, sf_dir)
    return read_parquet(spark, layout.master("weather_daily"))


def job_weather_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = _weather_job(spark, sf_dir)
    found = report.findings
    row = (report.input_rows, report.output.rows, found["unparsed_times"], found["faults"]["temperature_2m"]["failed"], report.quarantine.rows)
    return spark.createDataFrame([row], "input_rows long, output_rows long, unparsed_times long, failed_temperatures long, quarantined long")


def job_weather_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, _ = _weather_job(spark, sf_dir)
    rows = read_parquet(spark, layout.debug("quarantine/weather_daily")).select("city", F.explode("faults").alias("entry"))
    return rows.select("city", F.col("entry.column").alias("column_name"), "entry.text").groupBy("city", "column_name", "text").agg(F.count(F.lit(1)).alias("readings"))


def _family(spark: SparkSession, sf_dir: str, most_paths: int) -> DataFrame:
    """Cities in three folders: the columns in order; shuffled; without rain but with a further column."""
    base = scratch_path(spark, "family")
    rows = _reading_text(spark, sf_dir)
    kind = F.regexp_extract("city", r"(\d+)$", 1).cast("int") % 3
    layouts = (
        ["date", "temperature_2m", "relative_humidity_2m", "precipitation"],
        ["precipitation", "date", "relative_humidity_2m", "temperature_2m"],
        ["temperature_2m", "date", "note", "relative_humidity_2m"],
    )
    for i, columns in enumerate(layouts):
        part = rows.filter(kind == i).withColumn("note", F.lit("n/a")).select("city", *columns)
        write_table(part, uri(base, f"kind{i}"), "csv", partition_by=["city"])
    text = read_family(spark, uri(base, "*/*/*.csv"), schemas.weather().names, "city", CITY_FOLDER, most_paths=most_paths)
    return masters.weather_daily(typed(text, schemas.weather()).visible, minor_digits=READING_DIGITS)


def weather_of_any_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family(spark, sf_dir, 10_000)


def weather_of_any_headers_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the way taken where there are too many files to list."""
    return _family(spark, sf_dir, 1)


def _listed_job(spark: SparkSession, sf_dir: str, most_paths: int) -> DataFrame:
    layout = _city_layout(spark, _reading_text(spark, sf_dir))
    names = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") % 2 == 0)
    export_csv(names.select(F.concat(F.lit(" "), F.replace("n_name", F.lit("_"), F.lit(" "))).alias("City Name")), layout.raw("names.csv"))
    jobs.build_weather_daily(
        spark, layout, source="cities", names="names.csv", pattern=CITY_FOLDER, depth=1, most_paths=most_paths, digits=READING_DIGITS, underscore_as_space=True
    )
    return read_parquet(spark, layout.master("weather_daily"))


def job_weather_of_listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed_job(spark, sf_dir, 10_000)


def job_weather_of_listed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the way taken where more files are listed than the driver is to hold."""
    return _listed_job(spark, sf_dir, 3)


# --- masters and summaries as jobs -------------------------------------------------------------------


def _raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales as text with the columns of the raw file; days of every seventh product are written in another format."""
    rows = sales(spark, sf_dir)
    day = F.when(F.col("product_id") % 7 == 0, F.date_format("festival_date", "yyyy/MM/dd")).otherwise(F.date_format("festival_date", "dd-MM-yyyy"))
    money = {c: F.col(c).cast("decimal(18,2)") for c in MONEY}
    return rows.withColumns(money).withColumn("festival_date", day).select(*schemas.products().names)


def _masters(spark: SparkSession, sf_dir: str) -> tuple[jobs.Layout, list[jobs.JobReport]]:
    """Products and festival sales are there; the readings are not."""
    layout = _layout(spark)
    export_csv(_raw_sales(spark, sf_dir), layout.raw("products.csv"), **PACKED)
    rows = _raw_sales(spark, sf_dir)
    festival = {"ProductID": "product_id", "ProductName": "product", "Category": "product_category", "Sales": "units_sold", "State": "state", "Region": "state",
                "City": "city", "Latitude": "latitude", "Longitude": "longitude", "Date": "festival_date", "Festival": "festival"}
    export_csv(rows.select(*[F.col(own).alias(name) for name, own in festival.items()]), layout.raw("Festival_Sales.csv"), **PACKED)
    return layout, jobs.build_masters(spark, layout)


def job_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the masters job reports: a missing source is passed over, days that are none are counted."""
    _, reports = _masters(spark, sf_dir)
    rows = [(r.job, r.status, r.input_rows, r.findings.get("unparsed_days"), r.quarantine.rows if r.quarantine else None) for r in reports]
    return spark.createDataFrame(rows, "job string, status string, input_rows long, unparsed_days long, quarantined long")


def job_products_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, _ = _masters(spark, sf_dir)
    return read_parquet(spark, layout.master("products")).drop("seller_rating", "revenue_INR", "price_INR", "latitude", "longitude")


def job_festival_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, _ = _masters(spark, sf_dir)
    back = read_parquet(spark, layout.master("festival_sales"))
    return back.groupBy("Category", "Festival", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("Sales").alias("sales"))


def _star_masters(spark: SparkSession, sf_dir: str, days: Column | None = None) -> jobs.Layout:
    """Both masters made of the star; sales fall into January 2024, where the readings are."""
    layout = _layout(spark)
    rows = sales(spark, sf_dir).withColumns({c: F.col(c).cast("decimal(18,2)") for c in MONEY})
    rows = rows.withColumn("festival_date", F.col("sale_day")).drop("sale_day", "year", "month", "day")
    rows = rows.withColumns({"year": F.year("festival_date"), "month": F.month("festival_date"), "day": F.dayofmonth("festival_date")})
    write_parquet(rows, layout.master("products"), ["year", "month"])
    weather = masters.weather_daily(readings(spark, sf_dir), minor_digits=READING_DIGITS)
    write_parquet(weather if days is None else weather.filter(days), layout.master("weather_daily"), ["year", "month"])
    return layout


def job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and written by each summary job, counted by its write."""
    layout = _star_masters(spark, sf_dir)
    names = ("overall_kpis", "festival_category_summary", "geo_summary", "weather_sales_summary", "payment_vendor_summary")
    reports = [jobs.JOBS[name](spark, layout) for name in names]
    return spark.createDataFrame([(r.job, r.input_rows, r.output.rows) for r in reports], "job string, input_rows long, output_rows long")


def job_unmatched_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample that the weather job writes when too many sales find no weather: there is none after the 20th."""
    layout = _star_masters(spark, sf_dir, F.dayofmonth("date") <= 20)
    report = jobs.run_weather_sales_summary(spark, layout)
    return read_csv(spark, report.findings["sample"], spark.createDataFrame([], "city string, join_date date").schema, by="position", header="false")


# --- refresh -----------------------------------------------------------------------------------------


def _refreshed(spark: SparkSession, sf_dir: str, job: str) -> DataFrame:
    """A summary that is refreshed after one year of its master was written anew with doubled units."""
    layout = _layout(spark)
    rows = sales(spark, sf_dir).withColumns({c: F.col(c).cast("decimal(18,2)") for c in MONEY}).drop("sale_day")
    write_parquet(rows, layout.master("products"), ["year", "month"])
    refresh.refresh(spark, layout, job)
    doubled = rows.filter(F.col("year") == CHANGED_YEAR).withColumn("units_sold", F.col("units_sold") * 2)
    write_parquet(doubled, layout.master("products"), ["year", "month"], dynamic=True)
    refresh.refresh(spark, layout, job)
    return read_parquet(spark, layout.summary(job))


def job_refresh_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "overall_kpis")


def job_refresh_festivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.readable(_refreshed(spark, sf_dir, "festival_category_summary"))


def job_refresh_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "geo_summary")


def job_refresh_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "payment_vendor_summary")


# --- bounded results ---------------------------------------------------------------------------------


def top_products_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of three products at most by units, of which many tie, and how many more tie with the last one."""
    per_product = totals(sales(spark, sf_dir, *FESTIVAL_YEAR, "product", "units_sold"), [*FESTIVAL_YEAR, "product"], "units_sold", "total")
    top = bounded_top(per_product, FESTIVAL_YEAR, "product", "total", 3, "top_products", "units")
    return top.withColumn("top_products", items_as_text(F.col("top_products"), measure="units"))


def festival_category_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, *FESTIVAL_YEAR, "product_category", "product", *SALE_INPUTS)
    summary = summaries.festival_category_summary(rows, ties="bounded", minor_digits=MONEY_DIGITS)
    return summary.withColumn("top_products", items_as_text(F.col("top_products")))


def scatter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 400 line items of each return flag, the same whatever the partitioning."""
    rows = table(spark, sf_dir, "lineitem")
    return explore.scatter_sample(rows, "l_quantity", "l_extendedprice", "l_returnflag", 400, ["l_orderkey", "l_linenumber"])


def scatter_sample_of_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewer suppliers than the bound: all of them."""
    return explore.scatter_sample(table(spark, sf_dir, "supplier"), "s_acctbal", "s_nationkey", n=1_000_000)


# --- looking at tables -------------------------------------------------------------------------------

FIRST_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


def inspect_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three rows of every table, value by value, as one plan."""
    return explore.first_values({name: table(spark, sf_dir, name) for name in FIRST_KEYS}, FIRST_KEYS)


def load_by_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary as CSV and as Parquet, loaded by what its name says; a third one is not there."""
    rows = sales(spark, sf_dir, "vendor_type", "payment_methods", "year", *summaries.VENDOR.inputs)
    summary = summaries.payment_vendor_summary(rows, MONEY_DIGITS)
    base = scratch_path(spark, "loads")
    write_parquet(summary, uri(base, "vendors"))
    export_csv(read_parquet(spark, uri(base, "vendors")), uri(base, "vendors.CSV"))
    found = {name: if_exists(lambda: read_table(spark, uri(base, name), **more)) for name, more in (("vendors", {}), ("vendors.CSV", {"schema": summary.schema}), ("none.csv", {}))}
    return found["vendors"].withColumn("loaded_as", F.lit("parquet")).unionByName(found["vendors.CSV"].withColumn("loaded_as", F.lit("csv"))).withColumn(
        "missing", F.lit(sum(df is None for df in found.values()))
    )


def _explored(spark: SparkSession, sf_dir: str, job: str, target: str, **options) -> DataFrame:
    """An exploration job over a stored summary, and what it wrote."""
    layout = _layout(spark)
    rows = sales(spark, sf_dir, "vendor_type", "payment_methods", "year", *summaries.VENDOR.inputs)
    write_parquet(summaries.payment_vendor_summary(rows, MONEY_DIGITS), layout.summary("vendors"))
    exploration.EXPLORATION[job](spark, layout, "processed/summary/vendors", target, **options)
    return read_table(spark, layout.raw(target), **({"infer": True} if target.endswith(".csv") else {}))


def job_filter_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered table as CSV text; years are given as text and compared as numbers."""
    return _explored(spark, sf_dir, "filter_values", "found.csv", column="year", values=["1993", "1996"])


def job_bar_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _explored(spark, sf_dir, "bar_data", "bars", x="vendor_type", y="total_units", color="year")


def tables_through_mount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, partitioned write, listing and CSV scan by file name, all through a mount table instead of local paths."""
    base = mount(spark, {"in": sf_dir, "out": scratch_path(spark, "mounted")})
    hourly = readings(spark, uri(base, "in")).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    write_table(hourly, uri(base, "out/cities"), "csv", partition_by=["city"])
    layout = jobs.Layout(uri(base, "out"))
    jobs.build_weather_daily(spark, layout, source="cities/*/*.csv", pattern=CITY_FOLDER, digits=READING_DIGITS, headers="any")
    files = list_files(spark, layout.master("weather_daily"), (".parquet",))
    listed = files.agg(F.countDistinct(F.regexp_extract("path", r"/(year=[^/]+/month=[^/]+)/", 1)).alias("n")).scalar()
    daily = read_parquet(spark, layout.master("weather_daily"))
    by_city = summarize(daily, ["city"], Measures(sums={"rain": "total_precip_mm"}, rows="n_days", minor_digits=READING_DIGITS))
    return by_city.select("city", "rain", "n_days", listed.alias("month_folders"))


JOB_QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        job_typed_csv, job_typed_csv_account, job_typed_csv_quarantine, job_inferred_csv, inferred_types, job_weather_daily, job_weather_account,
        job_weather_quarantine, weather_of_any_headers, weather_of_any_headers_by_position, job_weather_of_listed_files, job_weather_of_listed_keys,
        job_masters, job_products_master, job_festival_master, job_counts, job_unmatched_alarm, job_refresh_kpis, job_refresh_festivals, job_refresh_places,
        job_refresh_vendors, top_products_bounded, festival_category_bounded, scatter_sample, scatter_sample_of_few, inspect_tables, load_by_extension,
        job_filter_export, job_bar_data, tables_through_mount,
    )
}
