"""Numeric bands and flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Band:
    """Values below ``limit`` (or up to and including it) that no earlier band took."""

    label: str
    limit: float
    inclusive: bool


@dataclass(frozen=True)
class Bands:
    """Ascending bands; ``rest`` labels what none of them takes."""

    steps: tuple[Band, ...]
    rest: str


# Band labels and edges that the summaries are grouped by.
TEMPERATURE = Bands(
    (Band("<15", 15, False), Band("15-25", 25, True), Band("25-35", 35, True)),
    rest=">35",
)
HUMIDITY = Bands(
    (Band("<40", 40, False), Band("40-70", 70, True)),
    rest=">70",
)


def band(value: Column, bands: Bands, unknown_label: str | None = None) -> Column:
    """Label of the band that ``value`` falls in.

    Null and NaN have no upper edge that takes them and so end in ``rest``; with ``unknown_label`` they
    get a band of their own.
    """
    chain = None
    if unknown_label is not None:
        missing = value.isNull() | F.isnan(value.cast("double"))
        chain = F.when(missing, F.lit(unknown_label))
    for step in bands.steps:
        inside = value <= step.limit if step.inclusive else value < step.limit
        chain = F.when(inside, step.label) if chain is None else chain.when(inside, step.label)
    return F.lit(bands.rest) if chain is None else chain.otherwise(bands.rest)


def positive_flag(value: Column) -> Column:
    """True when ``value`` is above zero, False otherwise and for null."""
    return F.coalesce(value > 0, F.lit(False))
