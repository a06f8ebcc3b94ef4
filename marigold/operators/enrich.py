"""Left enrichment of one table by another, and the report on what found no partner.

No join carries a hint: statistics and adaptive execution pick broadcast only for a side measured to be
small, and otherwise a sort-merge join whose oversized partitions are split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

MATCHED = "__matched"


def enrich(left: DataFrame, right: DataFrame, on: Mapping[str, str], take: Sequence[str], marker: str = MATCHED) -> DataFrame:
    """All rows of ``left`` with the ``take`` columns of ``right`` and a ``marker`` that is null without a partner.

    A second enrichment of the same table needs a marker of its own.

    ``on`` maps left keys to right keys. ``right`` is cut down to its keys and the wanted columns before
    the join, so that names both sides share are not ambiguous afterwards. Null keys find no partner.
    """
    if marker in left.columns:
        raise ValueError(f"the table already has a column {marker}: name another marker")
    slim = right.select(
        *[F.col(key).alias(f"__key{i}") for i, key in enumerate(on.values())],
        *take,
        F.lit(True).alias(marker),
    )
    same = [F.col(key) == F.col(f"__key{i}") for i, key in enumerate(on)]
    condition = same[0]
    for equal in same[1:]:
        condition = condition & equal
    return left.join(slim, condition, "left").drop(*[f"__key{i}" for i in range(len(on))])


def match_counts(measure: str, weight: str | None = None, marker: str = MATCHED) -> list[Column]:
    """Aggregates over an enriched table: rows, rows without a partner, rows without a measure.

    ``weight`` names a column that holds how many rows a pre-aggregated row stands for.
    """
    each = F.lit(1) if weight is None else F.col(weight)
    none = F.lit(0).cast("bigint")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, each).otherwise(none)), none).cast("bigint")

    return [
        rows_where(F.lit(True)).alias("total_rows"),
        rows_where(F.col(marker).isNull()).alias("no_key"),
        rows_where(F.col(measure).isNull()).alias("no_measure"),
    ]


def match_report(enriched: DataFrame, measure: str, weight: str | None = None, threshold: float = 0.05, marker: str = MATCHED) -> DataFrame:
    """One row: the counts of ``match_counts``, the share without a measure and whether it passes ``threshold``."""
    counts = enriched.agg(*match_counts(measure, weight, marker))
    share = F.coalesce(F.try_divide(F.col("no_measure"), F.col("total_rows")), F.lit(0.0))
    return counts.withColumn("unmatched_ratio", share).withColumn("alarm", F.col("unmatched_ratio") > threshold)


def unmatched_sample(enriched: DataFrame, keys: Sequence[str], measure: str, n: int = 10, weight: str | None = None) -> DataFrame:
    """Keys of the first ``n`` rows without a measure, in key order, so that the sample is repeatable.

    With ``weight`` every pre-aggregated row counts as that many rows; ``n`` distinct keys always suffice.
    """
    order = [F.col(key).asc_nulls_first() for key in keys]
    missing = enriched.filter(F.col(measure).isNull())
    if weight is None:
        return missing.select(*keys).orderBy(*order).limit(n)
    first = missing.select(*keys, weight).orderBy(*order).limit(n)
    copies = F.sequence(F.lit(1), F.least(F.col(weight), F.lit(n)).cast("int"))
    return first.select(*keys, F.explode(copies)).drop("col").orderBy(*order).limit(n)
