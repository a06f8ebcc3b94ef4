"""Read, check, compute, write: the jobs a user submits.

A job evaluates its plan once; the counts it reports, those of its input included, are observed by the write itself. A
failing job raises; only a missing raw source is reported and
passed over, because sources arrive independently.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from marigold.functions.calendar import DAY_FORMAT, day_in_zone, in_period
from marigold.functions.text import FILE_STEM, FILE_STEM_ANY_SEPARATOR
from marigold.operators.checks import MissingColumns, require
from marigold.operators.explore import describe_columns, first_rows
from marigold.plans import masters, summaries
from marigold.sources import schemas
from marigold.sources.families import read_family
from marigold.sources.files import MOST_PATHS, choose_files, read_chosen, with_file_key
from marigold.sources.sinks import Written, export_csv, write_parquet
from marigold.sources.tables import if_exists, read_csv, read_parquet, uri
from marigold.sources.typed import Typed, fault_account, infer_on_the_way, read_typed_csv, typed, write_typed
from marigold.staging import Staging


@dataclass(frozen=True)
class Layout:
    """Where the tables lie below a base URI."""

    base: str

    def raw(self, name: str) -> str:
        return uri(self.base, name)

    def master(self, name: str) -> str:
        return uri(self.base, "processed/master", name)

    def summary(self, name: str) -> str:
        return uri(self.base, "processed/summary", name)

    def debug(self, name: str) -> str:
        return uri(self.base, "processed/debug", name)


@dataclass(frozen=True)
class JobReport:
    """What a job did: ``done`` or ``missing``, rows read and written, findings on the way, and rows put aside."""

    job: str
    status: str
    input_rows: int | None = None
    output: Written | None = None
    findings: dict = field(default_factory=dict)
    quarantine: Written | None = None

    def as_dict(self) -> dict:
        return asdict(self)


# How each master and summary is partitioned on disk.
PARTITIONS = {
    "festival_sales": (),
    "products": ("year", "month"),
    "weather_daily": ("year", "month"),
    "overall_kpis": ("year", "month"),
    "festival_category_summary": ("year",),
    "geo_summary": ("state", "year"),
    "weather_sales_summary": ("year", "month"),
    "payment_vendor_summary": (),
}


def _reported(scan: Typed, written: Written, days: str, quarantine: str) -> tuple[dict, Written | None]:
    """Findings of a typed write, and the quarantine: rows with faults are written there when there are any.

    Days (or times) that did not parse are counted under ``days``; other faults are listed by column.
    """
    account = fault_account(written.metrics)
    found = {f"unparsed_{days}": written.metrics.get(f"failed {scan.checked[-1]}", 0)}
    others = {column: counts for column, counts in account.items() if column != scan.checked[-1]}
    if others:
        found["faults"] = others
    return found, write_parquet(scan.faults(account), quarantine) if account else None


def _master_from_text(
    layout: Layout, job: str, raw: Typed | None, plan: Callable[[DataFrame], DataFrame], text_day: str, typed_day: str
) -> JobReport:
    """Write a master with one row per raw row; values that did not fit are counted by the write."""
    if raw is None:
        return JobReport(job, "missing")
    scan = raw.checking(text_day, plan, typed_day)
    written = write_parquet(scan.rows, layout.master(job), PARTITIONS[job], metrics=scan.counts(), hidden=scan.hidden)
    findings, quarantine = _reported(scan, written, "days", layout.debug(f"quarantine/{job}"))
    return JobReport(job, "done", written.rows, written, findings, quarantine)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _festival_file(spark: SparkSession, path: str, strict: bool) -> Typed:
    """The raw festival sales by the names in their header, further columns included.

    A header that holds ``Date`` and ``date`` names no column for sure: it is read by position, if it has the columns
    of the schema and those two in the order that the schema has.
    """
    schema = schemas.festival_sales()
    header = read_csv(spark, path).columns
    if set(schema.names) <= set(header):
        return typed(read_csv(spark, path, _text_schema(header)), schema, strict)
    plain = [name.rstrip("0123456789") for name in header]  # Spark tells names apart by their position
    if len(plain) < len(schema.names) or plain[: len(schema.names)] != schema.names:
        raise MissingColumns(f"festival sales: the header {header} does not hold the columns {schema.names}")
    return typed(read_csv(spark, path, _text_schema([*schema.names, *header[len(schema.names) :]]), by="position"), schema, strict)


def build_festival_sales(spark: SparkSession, layout: Layout, source: str = "Festival_Sales.csv", fmt: str = DAY_FORMAT, strict: bool = False) -> JobReport:
    raw = if_exists(lambda: _festival_file(spark, layout.raw(source), strict))
    return _master_from_text(layout, "festival_sales", raw, lambda df: masters.festival_sales(df, fmt, strict), "Date", "date")


def build_products(spark: SparkSession, layout: Layout, source: str = "products.csv", fmt: str = DAY_FORMAT, strict: bool = False) -> JobReport:
    raw = if_exists(lambda: read_typed_csv(spark, layout.raw(source), schemas.products(), strict))
    return _master_from_text(layout, "products", raw, lambda df: masters.products(df, fmt, strict), "festival_date", "festival_date")


def _readings_by_file(spark: SparkSession, headers: str, pattern: str) -> Callable[[str | list[str], str], DataFrame]:
    """A scan of city files as text with a key column: files with one header, or with any."""
    names = schemas.weather().names
    if headers == "any":
        return lambda paths, key: read_family(spark, paths, names, key, pattern)
    if headers != "same":
        raise ValueError(f"headers must be 'same' or 'any', not {headers!r}")

    def read(paths: str | list[str], key: str) -> DataFrame:
        return with_file_key(read_csv(spark, paths, _text_schema(read_csv(spark, paths).columns)), key, pattern)

    return read


def build_weather_daily(
    spark: SparkSession,
    layout: Layout,
    source: str = "raw/*.csv",
    names: str | None = None,
    zone: str = "UTC",
    underscore_as_space: bool = False,
    strict: bool = False,
    headers: str = "same",
    pattern: str | None = None,
    depth: int = 0,
    most_paths: int = MOST_PATHS,
    digits: int | None = None,
) -> JobReport:
    """One CSV file of hourly readings per city, named after it.

    Without ``names`` every file that ``source`` matches is read. With ``names``, a CSV list of cities,
    ``source`` is a folder and only the files of listed cities are opened (beyond ``most_paths`` of them, all files are
    and rows of other cities are left out). With ``depth`` they lie so many folders below it, and ``pattern`` says where
    the key sits in a path. ``headers="any"`` reads files whose headers differ. ``digits`` declares how
    many decimal digits readings have, which makes their sums exact; a reading with more is then an error.

    Readings whose time is none, and values that are no numbers, are counted in the state of the roll-up and summed up
    behind its shuffle; those readings go to the quarantine, and readings without a day to no row of the master.
    """
    job, findings = "weather_daily", {}
    read = _readings_by_file(spark, headers, pattern or (FILE_STEM if names is None else FILE_STEM_ANY_SEPARATOR))
    if names is None:
        scan = if_exists(lambda: read(layout.raw(source), "city"))
        if scan is not None and underscore_as_space:
            scan = scan.withColumn("city", F.replace("city", F.lit("_"), F.lit(" ")))
    else:
        cities = if_exists(lambda: read_csv(spark, layout.raw(names), schemas.city_list(), by="position"))
        if cities is None:
            return JobReport(job, "missing", findings={"missing": names})
        with Staging(spark) as share:
            chosen = share(choose_files(spark, layout.raw(source), cities, "City Name", pattern or FILE_STEM, recursive=depth > 0))
            every = uri(layout.raw(source), *["*"] * depth, "*.csv")
            found = chosen.agg(F.countDistinct("path").alias("files"), F.count_if(F.col("path").isNull()).alias("names_without_file")).first()
            findings = found.asDict()
            scan = if_exists(lambda: read_chosen(read, chosen, lambda key: read(every, key), "city", underscore_as_space, most_paths))
            if scan is not None:
                return _weather_from_text(layout, job, scan, zone, strict, digits, findings)
    if scan is None:
        return JobReport(job, "missing", findings=findings)
    return _weather_from_text(layout, job, scan, zone, strict, digits, findings)


def _weather_from_text(layout: Layout, job: str, text: DataFrame, zone: str, strict: bool, digits: int | None, findings: dict) -> JobReport:
    require(text, ["city", *schemas.weather().names], "weather")
    raw = typed(text, schemas.weather(), strict)
    scan = raw.checking("date", lambda df: df.withColumn("date", day_in_zone(df, "date", zone, strict)))
    counts = scan.conditions()
    daily = masters.weather_daily(scan.rows, zone, rows="__readings", minor_digits=digits, tallies=counts)
    metrics = {"input_rows": F.sum("__readings"), **{name: F.sum(F.col(f"`{name}`")) for name in counts}}
    written = write_parquet(
        daily, layout.master(job), PARTITIONS[job], metrics=metrics, hidden=["__readings", *counts], keep=F.col("date").isNotNull()
    )
    told, quarantine = _reported(scan, written, "times", layout.debug(f"quarantine/{job}"))
    findings = {**findings, **{name: found for name, found in told.items() if found}}
    return JobReport(job, "done", written.metrics["input_rows"] or 0, written, findings, quarantine)


def build_masters(
    spark: SparkSession, layout: Layout, fmt: str = DAY_FORMAT, strict: bool = False, underscore_as_space: bool = False, headers: str = "same"
) -> list[JobReport]:
    """All masters whose raw files exist."""
    return [
        build_festival_sales(spark, layout, fmt=fmt, strict=strict),
        build_products(spark, layout, fmt=fmt, strict=strict),
        build_weather_daily(spark, layout, underscore_as_space=underscore_as_space, strict=strict, headers=headers),
    ]


INPUT_ROWS = "__input_rows"


def _sales(spark: SparkSession, layout: Layout, start: date | None, end: date | None) -> DataFrame:
    """The products master, or the days from ``start`` to ``end`` of it: other months are not opened."""
    sales = read_parquet(spark, layout.master("products"))
    if start is None and end is None:
        return sales
    return in_period(sales, "festival_date", start or date.min, end or date.max, PARTITIONS["products"])


def _run_summary(
    spark: SparkSession, layout: Layout, job: str, plan: Callable[[DataFrame], DataFrame], start: date | None, end: date | None, rows: str = INPUT_ROWS
) -> JobReport:
    """Write a summary. Its rows carry how many sales they stand for, so that the write counts the input of the very scan it used."""
    sales = _sales(spark, layout, start, end)
    hidden = [rows] if rows == INPUT_ROWS else []
    written = write_parquet(plan(sales), layout.summary(job), PARTITIONS[job], metrics={"input_rows": F.sum(rows)}, hidden=hidden)
    return JobReport(job, "done", written.metrics["input_rows"] or 0, written)


def run_overall_kpis(spark: SparkSession, layout: Layout, start: date | None = None, end: date | None = None) -> JobReport:
    return _run_summary(spark, layout, "overall_kpis", summaries.overall_kpis, start, end, rows="total_tx")


def run_festival_category_summary(
    spark: SparkSession, layout: Layout, start: date | None = None, end: date | None = None, ties: str = "all"
) -> JobReport:
    with Staging(spark) as share:
        plan = lambda df: summaries.festival_category_summary(df, ties=ties, share=share, rows=INPUT_ROWS)
        return _run_summary(spark, layout, "festival_category_summary", plan, start, end)


def run_geo_summary(spark: SparkSession, layout: Layout, start: date | None = None, end: date | None = None, ties: str = "all") -> JobReport:
    with Staging(spark) as share:
        plan = lambda df: summaries.geo_summary(df, ties=ties, share=share, rows=INPUT_ROWS)
        return _run_summary(spark, layout, "geo_summary", plan, start, end)


def run_payment_vendor_summary(spark: SparkSession, layout: Layout, start: date | None = None, end: date | None = None) -> JobReport:
    plan = lambda df: summaries.payment_vendor_summary(df, rows=INPUT_ROWS)
    return _run_summary(spark, layout, "payment_vendor_summary", plan, start, end)


def run_weather_sales_summary(
    spark: SparkSession, layout: Layout, start: date | None = None, end: date | None = None, unknown_label: str | None = None
) -> JobReport:
    """The weather summary with its match report; a sample of unmatched keys is written when the alarm is on.

    The joined city-days are staged once and feed the report, the sample and the summary. The report counts the rows of
    the weather table in the same action, from the files that the join read.
    """
    job = "weather_sales_summary"
    sales = _sales(spark, layout, start, end)
    weather = read_parquet(spark, layout.master("weather_daily"))
    with Staging(spark) as share:
        days = share(summaries.sales_days_with_weather(sales, weather))
        counted = summaries.unmatched_report(days).withColumn("weather_rows", weather.agg(F.count(F.lit(1))).scalar())
        report: Row = counted.first()
        findings = report.asDict()
        if report.alarm:
            sample = summaries.unmatched_days_sample(days)
            findings["sample"] = export_csv(sample, layout.debug("unmatched_joins"), header=False).path
        plan = summaries.weather_sales_from_days(days, unknown_label, INPUT_ROWS)
        written = write_parquet(plan, layout.summary(job), PARTITIONS[job], metrics={"input_rows": F.sum(INPUT_ROWS)}, hidden=[INPUT_ROWS])
        return JobReport(job, "done", written.metrics["input_rows"] or 0, written, findings)


def csv_to_parquet(
    spark: SparkSession,
    layout: Layout,
    source: str,
    target: str,
    schema: T.StructType | None = None,
    shown: int = 5,
    strict: bool = False,
    decimals: bool = False,
) -> JobReport:
    """Any CSV file with a header as Parquet, with its schema, its first rows, its row count and an account of faults.

    Without a schema, types are inferred while the text is staged: the CSV is taken apart once, and conversion reads
    the staged columns. ``decimals`` makes numbers with a point decimals of the digits met, not doubles.
    """
    job = "csv_to_parquet"
    raw = if_exists(lambda: read_csv(spark, layout.raw(source), _text_schema(read_csv(spark, layout.raw(source)).columns)))
    if raw is None:
        return JobReport(job, "missing")
    with Staging(spark) as share:
        if schema is None:
            raw, schema = infer_on_the_way(raw, share, decimals)
        made = write_typed(typed(raw, schema, strict), layout.raw(target), layout.debug(f"quarantine/{target.strip('/')}"))
    first = [row.asDict() for row in first_rows(read_parquet(spark, layout.raw(target)), shown)]
    findings = {"first_rows": first, **({"faults": made.faults} if made.faults else {})}
    return JobReport(job, "done", made.written.rows, made.written, findings, made.quarantine)


def inspect(spark: SparkSession, layout: Layout, *sources: str, shown: int = 3) -> list[JobReport]:
    """Columns and first rows of raw files; a missing file is reported and the others go on."""
    reports = []
    for source in sources:
        raw = if_exists(lambda: read_csv(spark, layout.raw(source)))
        if raw is None:
            reports.append(JobReport("inspect", "missing", findings={"source": source}))
            continue
        rows = [row.asDict() for row in first_rows(raw, shown)]
        found = {"source": source, "columns": describe_columns(raw), "first_rows": rows}
        reports.append(JobReport("inspect", "done", findings=found))
    return reports


JOBS: dict[str, Callable[[SparkSession, Layout], JobReport | list[JobReport]]] = {
    "masters": build_masters,
    "festival_sales": build_festival_sales,
    "products": build_products,
    "weather_daily": build_weather_daily,
    "overall_kpis": run_overall_kpis,
    "festival_category_summary": run_festival_category_summary,
    "geo_summary": run_geo_summary,
    "weather_sales_summary": run_weather_sales_summary,
    "payment_vendor_summary": run_payment_vendor_summary,
}
