"""Day parsing, calendar columns and zone-aware calendar days.

Everything here is a ``Column`` (or ``DataFrame``) expression over built-in functions, so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: the day format of the raw sales files.
DAY_FORMAT = "dd-MM-yyyy"


def _type_of(df: DataFrame, column: str) -> T.DataType:
    return df.select(F.col(column)).schema[0].dataType


def parse_day(df: DataFrame, column: str, fmt: str = DAY_FORMAT, strict: bool = False) -> Column:
    """Text day to ``date``. Bad text gives null, or an error with ``strict``.

    A column that already is a date or timestamp (schema inference may have typed it) is only cast.
    """
    if not isinstance(_type_of(df, column), (T.StringType, T.CharType, T.VarcharType)):
        return F.col(column).cast("date")
    return F.to_date(F.col(column), fmt) if strict else F.try_to_date(F.col(column), fmt)


def with_calendar(df: DataFrame, day: str, parts: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """Add calendar columns taken from the date column ``day``."""
    taken = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({part: taken[part](F.col(day)) for part in parts})


def instant(df: DataFrame, column: str, zone: str = "UTC") -> Column:
    """Text to ``timestamp``. Text without an offset is read as wall-clock time in ``zone``.

    Independent of the session zone: the zone is appended to the text, which only parses when the text
    has no offset of its own.
    """
    kind = _type_of(df, column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(column)
    return instant_of(F.col(column), zone)


def instant_of(text: Column, zone: str = "UTC") -> Column:
    """The ``timestamp`` of a text column, as ``instant`` reads it; null where it is none."""
    text = F.trim(text)
    return F.coalesce(
        F.try_to_timestamp(F.concat(text, F.lit(f" {zone}"))),
        F.try_to_timestamp(F.concat(text, F.lit(f" 00:00:00 {zone}"))),
        F.try_to_timestamp(text),
    )


def day_in_zone(df: DataFrame, column: str, zone: str = "UTC", strict: bool = False) -> Column:
    """Calendar day of a reading, as seen in ``zone`` whatever the session zone is.

    Text that is no time gives null, or an error with ``strict``. Accepts text, ``timestamp`` or ``timestamp_ntz``; the last is wall-clock time already.
    """
    kind = _type_of(df, column)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.col(column).cast("date")
    at = instant(df, column, zone)
    if strict and isinstance(kind, T.StringType):
        refused = F.raise_error(F.concat(F.lit(f"{column}: no time: "), F.col(column))).cast("timestamp")
        at = F.when(at.isNull() & (F.trim(F.col(column)) != ""), refused).otherwise(at)
    if zone.upper() in ("UTC", "Z", "GMT"):
        days = F.floor(F.unix_seconds(at) / F.lit(86400))
        return F.date_from_unix_date(days.cast("int"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_add("MICROSECOND", F.unix_micros(at), epoch))
    return wall.cast("date")


def in_period(df: DataFrame, day: str, start: date, end: date, partition_parts: Sequence[str] = ()) -> DataFrame:
    """Rows with ``start <= day <= end``.

    ``partition_parts`` says that the table is partitioned by ``year`` or by ``year`` and ``month`` *of this day*
    (as the masters are): the same bounds are put on them too, so that whole directories are pruned before any
    file is opened, months across the turn of a year included.
    """
    kept = df.filter(F.col(day).between(F.lit(start), F.lit(end)))
    if tuple(partition_parts) == ("year", "month"):
        month = F.col("year") * 12 + F.col("month")
        kept = kept.filter(month.between(start.year * 12 + start.month, end.year * 12 + end.month))
    elif tuple(partition_parts) not in ((), ("year",)):
        raise ValueError("a period is bounded by year, or by year and month")
    return kept.filter(F.col("year").between(start.year, end.year)) if partition_parts else kept
