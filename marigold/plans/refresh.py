"""Summaries that follow their master month by month.

A summary is made of sums and counts, so the rows of one month can be reduced to state rows once and for all. A refresh

1. lists the files of the master (names, sizes, times; no content) and compares each month's fingerprint with the one of
   the last refresh,
2. reduces the months that changed, and overwrites only their folders of the stored state,
3. makes the output partitions (years, or months) that hold such a month anew from state rows, and overwrites only these,
4. stores the new fingerprints. A refresh that fails on the way leaves the old ones, so that the next one does its work.

Months that left the master lose their state, and output partitions that hold nothing any more are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marigold.functions.calendar import with_calendar
from marigold.operators.checks import DAY, NUMBER, require
from marigold.operators.enrich import enrich
from marigold.operators.summarize import Measures, preaggregate, reported, roll_up
from marigold.plans import summaries
from marigold.plans.jobs import PARTITIONS, JobReport, Layout
from marigold.sources.files import list_files
from marigold.sources.sinks import write_parquet
from marigold.sources.tables import if_exists, read_parquet, uri
from marigold.staging import delete_folder

Month = tuple[int | None, int | None]
MARKS = "year int, month int, mark long"
MONTHS = ["year", "month"]
# Fixed value: the folder of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Followed:
    """How a summary is refreshed: master rows to state rows, which hold ``year`` and ``month``, and these to the summary."""

    reduce: Callable[[DataFrame], DataFrame]
    finish: Callable[[SparkSession, Layout, DataFrame, list[Month]], DataFrame]


def _fine(measures: Measures, keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    def run(sales: DataFrame) -> DataFrame:
        require(sales, {**dict.fromkeys([*keys, *MONTHS]), **dict.fromkeys(measures.inputs, NUMBER)}, "products")
        return preaggregate(sales, [*keys, *[c for c in MONTHS if c not in keys]], measures)

    return run


def _kpis(spark: SparkSession, layout: Layout, state: DataFrame, months: list[Month]) -> DataFrame:
    daily = reported(roll_up(state.withColumn("date", F.col("festival_date").cast("date")), ["date"]), ["date"], summaries.DAILY_KPIS)
    return with_calendar(daily, "date")


def _weather(spark: SparkSession, layout: Layout, state: DataFrame, months: list[Month]) -> DataFrame:
    measures = ["avg_temp_C", "avg_humidity_pct", "total_precip_mm"]
    weather = read_parquet(spark, layout.master("weather_daily")).filter(in_months(months))
    require(weather, {"city": None, "date": DAY, **dict.fromkeys(measures, NUMBER)}, "weather")
    dated = state.withColumn("join_date", F.col("festival_date").cast("date")).drop("festival_date", *MONTHS)
    readings = weather.withColumn("weather_date", F.col("date").cast("date"))
    return summaries.weather_sales_from_days(enrich(dated, readings, {"city": "city", "join_date": "weather_date"}, measures))


FOLLOWED = {
    "overall_kpis": Followed(_fine(summaries.DAILY_KPIS, ["festival_date"]), _kpis),
    "festival_category_summary": Followed(
        lambda sales: summaries.festival_fine(sales, more=["month"]), lambda spark, layout, state, months: summaries.festival_category_from_fine(state)
    ),
    "geo_summary": Followed(lambda sales: summaries.geo_fine(sales, more=["month"]), lambda spark, layout, state, months: summaries.geo_from_fine(state)),
    "weather_sales_summary": Followed(_fine(summaries.SALES_AND_ROWS, ["city", "festival_date"]), _weather),
    "payment_vendor_summary": Followed(
        _fine(replace(summaries.VENDOR, rows="sale_rows"), summaries.VENDOR_KEYS),
        lambda spark, layout, state, months: reported(roll_up(state, summaries.VENDOR_KEYS), summaries.VENDOR_KEYS, summaries.VENDOR),
    ),
}


def in_months(months: Iterable[Month]) -> Column:
    """Rows of the given months, null apart; a condition on partition columns, so other folders are not opened."""
    each = [F.col("year").eqNullSafe(F.lit(y)) & F.col("month").eqNullSafe(F.lit(m)) for y, m in months]
    return reduce(or_, each, F.lit(False))


def in_years(years: Iterable[int | None]) -> Column:
    return reduce(or_, [F.col("year").eqNullSafe(F.lit(y)) for y in years], F.lit(False))


def _folder_value(part: str) -> Column:
    text = F.regexp_extract("path", rf"/{part}=([^/]+)/", 1)
    return F.when((text != "") & (text != NO_VALUE), text).cast("int").alias(part)


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """``year, month, mark`` of the months of a table: a number that changes when a file comes, goes or is written anew."""
    files = list_files(spark, path, (".parquet",))
    mark = F.xxhash64("path", "length", F.col("modificationTime").cast("long")).alias("mark")
    return files.select(*[_folder_value(part) for part in MONTHS], mark).groupBy(*MONTHS).agg(F.bit_xor("mark").alias("mark"))


def _marks(table: DataFrame | None) -> dict[Month, int]:
    """One row a month comes to the driver."""
    return {(row.year, row.month): row.mark for row in table.collect()} if table is not None else {}


def _folders(spark: SparkSession, path: str, months: list[Month], monthly: bool) -> dict[str, int]:
    """The partition folders of an output that hold rows of the given months (or of their years), each with a fingerprint."""
    listed = if_exists(lambda: list_files(spark, path, (".parquet",)))
    if listed is None:
        return {}
    named = listed.select(F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"), F.xxhash64("path").alias("mark"), *[_folder_value(part) for part in MONTHS])
    touched = named.filter(in_months(months) if monthly else in_years({year for year, _ in months}))
    return {row.folder: row.mark for row in touched.groupBy("folder").agg(F.bit_xor("mark").alias("mark")).collect()}


def _within(months: Iterable[Month], start: date | None, end: date | None) -> list[Month]:
    """The months that a period touches, in order."""
    first, last = start or date.min, end or date.max
    bounded = start is not None or end is not None
    kept = [(y, m) for y, m in months if not bounded or (y is not None and m is not None and (first.year, first.month) <= (y, m) <= (last.year, last.month))]
    return sorted(kept, key=lambda month: tuple((part is not None, part or 0) for part in month))


def _partition(month: Month) -> list[str]:
    return [f"{part}={NO_VALUE if value is None else value}" for part, value in zip(MONTHS, month)]


def refresh(spark: SparkSession, layout: Layout, job: str, start: date | None = None, end: date | None = None) -> JobReport:
    """Bring a summary up to date with the master, doing again only what changed.

    ``start`` and ``end`` confine the work to the months of a period; other changes are left to a later refresh.
    """
    if job not in FOLLOWED:
        raise ValueError(f"no summary to follow: {job!r}")
    followed, by, target = FOLLOWED[job], PARTITIONS[job], layout.summary(job)
    state_path, marks_path = uri(layout.base, "processed/state", job), uri(layout.base, "processed/state", f"{job}_files")
    now = _marks(fingerprints(spark, layout.master("products")))
    if job == "weather_sales_summary":
        weather = _marks(fingerprints(spark, layout.master("weather_daily")))
        now = {month: mark ^ (weather.get(month, 0) * 3 & (1 << 62) - 1) for month, mark in now.items()}
    known = _marks(if_exists(lambda: spark.read.schema(MARKS).parquet(marks_path)))
    changed = _within([month for month in now if known.get(month) != now[month]], start, end)
    gone = _within([month for month in known if month not in now], start, end)
    shown = {"changed": ["/".join(_partition(m)) for m in changed], "gone": ["/".join(_partition(m)) for m in gone]}
    if not changed and not gone:
        return JobReport(job, "unchanged", findings=shown)

    rows, written = 0, None
    if changed:
        states = followed.reduce(read_parquet(spark, layout.master("products")).filter(in_months(changed)))
        rows = write_parquet(states, state_path, MONTHS, dynamic=True, metrics={"input_rows": F.sum("__rows")}).metrics["input_rows"] or 0
    for month in gone:
        delete_folder(spark, uri(state_path, *_partition(month)))
    done = {month: mark for month, mark in known.items() if month not in gone} | {month: now[month] for month in changed}

    touched, monthly = [*changed, *gone], by == tuple(MONTHS)
    held = [month for month in done if not by or (month in touched if monthly else month[0] in {year for year, _ in touched})]
    old = _folders(spark, target, touched, monthly) if by else {}
    if held:
        state = read_parquet(spark, state_path, {"year": "int", "month": "int"}).filter(in_months(held))
        written = write_parquet(followed.finish(spark, layout, state, held), target, by, dynamic=bool(by))
    elif not by:
        delete_folder(spark, target)
    if by:
        fresh = _folders(spark, target, touched, monthly)
        for folder, mark in old.items():
            if fresh.get(folder) == mark:  # nothing was written there: its rows are gone
                delete_folder(spark, folder)
    table = [(year, month, mark) for (year, month), mark in done.items()]
    write_parquet(spark.createDataFrame(table, MARKS).coalesce(1), marks_path)
    return JobReport(job, "done", rows, written, shown)
