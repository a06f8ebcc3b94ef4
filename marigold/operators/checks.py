"""Input checks on names and types, and counts of values that did not parse."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What a measure or key may be declared as in ``require``.
NUMBER = T.NumericType
TEXT = T.StringType
DAY = (T.DateType, T.TimestampType, T.TimestampNTZType)


class MissingColumns(ValueError):
    """A table lacks columns that a plan needs, or has them with an unusable type."""


def require(df: DataFrame, columns: Iterable[str] | Mapping[str, type | tuple[type, ...]], table: str = "input") -> DataFrame:
    """Return ``df`` when it has all ``columns`` (names are case-sensitive), else raise and name every fault.

    Given a mapping, the types are checked too. Only the schema is looked at; no job runs.
    """
    wanted = columns if isinstance(columns, Mapping) else dict.fromkeys(columns)
    have = {field.name: field.dataType for field in df.schema}
    faults = [name for name in wanted if name not in have]
    faults += [
        f"{name} ({have[name].simpleString()})"
        for name, kind in wanted.items()
        if name in have and kind is not None and not isinstance(have[name], kind)
    ]
    if faults:
        raise MissingColumns(f"{table}: missing or unusable columns: {', '.join(faults)}")
    return df


def unparsed(text: Column, parsed: Column) -> Column:
    """Aggregate: values that hold text but gave null when parsed."""
    return F.count_if((F.trim(text.cast("string")) != "") & parsed.isNull())


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in table order."""
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    """Names of the text columns, in table order."""
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def date_like_columns(df: DataFrame) -> list[str]:
    """Names that speak of a date or a year, in table order."""
    return [name for name in df.columns if "date" in name.lower() or "year" in name.lower()]
