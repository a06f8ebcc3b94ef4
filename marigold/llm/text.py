"""Words and lines as column expressions, and names that clash with no column of the caller."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def count_words(text: Column) -> Column:
    """How many words a text has; 0 for null. The two blanks make every text begin and end with an empty part."""
    padded = F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))
    return (F.size(F.split(padded, SPACE, -1)) - 2).cast("long")


def has_word(line: Column) -> Column:
    return line.rlike(WORD)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return df[f"`{name.replace('`', '``')}`"]
