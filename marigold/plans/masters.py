"""Raw rows to typed master tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from marigold.functions.bands import positive_flag
from marigold.functions.calendar import DAY_FORMAT, day_in_zone, parse_day, with_calendar
from marigold.operators.checks import require
from marigold.operators.summarize import Measures, summarize

# What the daily weather carries where the readings say nothing.
UNKNOWN_STATE = "Unknown"
UNKNOWN_COORDINATE = 0.0

READINGS = Measures(
    means={"avg_temp_C": "temperature_2m", "avg_humidity_pct": "relative_humidity_2m"},
    sums={"total_precip_mm": "precipitation"},
)


def festival_sales(raw: DataFrame, fmt: str = DAY_FORMAT, strict: bool = False) -> DataFrame:
    """Festival sales with a typed ``date`` in place of the text ``Date``."""
    require(raw, ["Date"], "festival sales")
    return raw.withColumn("Date", parse_day(raw, "Date", fmt, strict)).withColumnRenamed("Date", "date")


def products(raw: DataFrame, fmt: str = DAY_FORMAT, strict: bool = False) -> DataFrame:
    """Product transactions with a typed ``festival_date`` and its calendar columns."""
    require(raw, ["festival_date"], "products")
    typed = raw.withColumn("festival_date", parse_day(raw, "festival_date", fmt, strict))
    return with_calendar(typed, "festival_date")


def weather_daily(
    readings: DataFrame,
    zone: str = "UTC",
    city: str = "city",
    at: str = "date",
    rows: str | None = None,
    minor_digits: int | None = None,
    tallies: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Hourly readings to one row per city and calendar day in ``zone``; ``rows`` adds their number.

    Readings whose time is none end in a row without a day, which a job counts and leaves out. ``tallies`` adds how
    many readings of each row fulfil a condition: such counts are part of the aggregate's state, so they can be summed
    up behind the shuffle.

    Partial aggregation runs before the one shuffle, so a city with most of the readings costs no more
    than its days.
    """
    require(readings, [city, at, *READINGS.inputs], "weather")
    flags = {name: (f"__is{i}", condition) for i, (name, condition) in enumerate((tallies or {}).items())}
    day = day_in_zone(readings, at, zone).alias("date")
    hourly = readings.select(F.col(city).alias("city"), day, *READINGS.inputs, *[c.alias(flag) for flag, c in flags.values()])
    counted = {name: F.col(flag) for name, (flag, _) in flags.items()}
    daily = summarize(hourly, ["city", "date"], replace(READINGS, rows=rows, minor_digits=minor_digits, tallies=counted))
    flagged = daily.withColumn("rain_flag", positive_flag(F.col("total_precip_mm")))
    return with_calendar(flagged, "date").withColumns(
        {
            "state": F.lit(UNKNOWN_STATE),
            "latitude": F.lit(UNKNOWN_COORDINATE),
            "longitude": F.lit(UNKNOWN_COORDINATE),
        }
    )
