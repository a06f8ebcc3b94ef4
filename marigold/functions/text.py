"""Keys from file names, list clean-up, and numbers and arrays as text for people to read."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Where the key sits in a path. The second also stops at a backslash and a pipe.
FILE_STEM = r"([^/]+)\.csv$"
FILE_STEM_ANY_SEPARATOR = r"([^/|\\]+)\.csv$"

# Fixed value: sign put before revenue figures.
RUPEE = "₹"


def key_in_path(path: Column, pattern: str = FILE_STEM, underscore_as_space: bool = False) -> Column:
    """Group 1 of ``pattern`` in a path, with URI escapes decoded; null when the pattern does not match.

    Spark hands out paths as URIs, where a blank is ``%20`` but a plus sign stands for itself; the plus is
    escaped first because form decoding would turn it into a blank.
    """
    raw = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    key = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.replace(key, F.lit("_"), F.lit(" ")) if underscore_as_space else key


def clean_name(name: Column) -> Column:
    """Trimmed name; null when nothing is left."""
    return F.nullif(F.regexp_replace(name, r"^\s+|\s+$", ""), F.lit(""))


def file_stem_for(name: Column) -> Column:
    """A listed name as it is spelt in file names: blanks become underscores."""
    return F.replace(name, F.lit(" "), F.lit("_"))


def whole_number(value: Column) -> Column:
    """``1234567.5`` as ``1,234,568``."""
    return F.format_number(value.cast("double"), 0)


def two_decimals(value: Column) -> Column:
    """``1234.5`` as ``1234.50``, ties rounded to even on the binary value."""
    return F.translate(F.format_number(value.cast("double"), 2), ",", "")


def label_of(name: str) -> str:
    """Column name as a label: ``total_revenue`` is shown as ``Total Revenue``."""
    return name.replace("_", " ").title()


def items_as_text(items: Column, item: str = "product", measure: str = "revenue") -> Column:
    """``[{A, 1234}, {B, 567}]`` as ``A (₹1,234), B (₹567)``; ``N/A`` for a null array."""
    shown = F.transform(
        items,
        lambda x: F.concat(
            F.coalesce(x[item].cast("string"), F.lit("None")),
            F.lit(f" ({RUPEE}"),
            F.coalesce(whole_number(x[measure]), F.lit("nan")),
            F.lit(")"),
        ),
    )
    return F.coalesce(F.array_join(shown, ", "), F.lit("N/A"))
