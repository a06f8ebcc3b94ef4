"""Top items per group.

Totals are aggregated per (group, item) first, so a hot group is spread over its items; the rank filter
directly above the window lets Spark cut every partition down to its best rows *before* they are shuffled
to the group's task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from marigold.operators.summarize import totals

RANK = "rank"


def keep_top(totalled: DataFrame, group: Sequence[str], item: str, measure: str, n: int, ties: str = "all") -> DataFrame:
    """Rows of ``totalled`` whose ``measure`` ranks among the ``n`` highest of their group, with the rank.

    ``ties="all"`` keeps every row that shares a kept rank, so a group may hold more than ``n``;
    ``ties="first"`` keeps exactly ``n``, equal measures ordered by ``item``. Nulls rank last.
    """
    if ties == "all":
        order, position = [F.col(measure).desc()], F.rank()
    elif ties == "first":
        order, position = [F.col(measure).desc(), F.col(item).asc()], F.row_number()
    else:
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    window = Window.partitionBy(*group).orderBy(*order)
    return totalled.withColumn(RANK, position.over(window)).filter(F.col(RANK) <= n)


def top_items(
    df: DataFrame,
    group: Sequence[str],
    item: str,
    measure: str,
    n: int,
    ties: str = "all",
    total: str = "total",
    minor_digits: int | None = None,
) -> DataFrame:
    """The ``n`` items of each group with the highest sum of ``measure``."""
    return keep_top(totals(df, [*group, item], measure, total, minor_digits), group, item, total, n, ties)


def top_label(totalled: DataFrame, group: Sequence[str], label: str, measure: str, alias: str, ties: str = "all") -> DataFrame:
    """The label with the highest ``measure`` in each group of ``totalled``, which has one row per (group, label).

    One row per tied label by default.
    """
    return keep_top(totalled, group, label, measure, 1, ties).select(*group, F.col(label).alias(alias))


def collect_top(top: DataFrame, group: Sequence[str], item: str, measure: str, alias: str, measure_alias: str) -> DataFrame:
    """One array of (item, measure) structs per group, highest first, ties by item."""
    entry = F.struct(F.col(RANK), F.col(item), F.col(measure).alias(measure_alias))
    ordered = F.sort_array(F.collect_list(entry))
    slim = F.transform(ordered, lambda x: F.struct(x[item].alias(item), x[measure_alias].cast("double").alias(measure_alias)))
    return top.groupBy(*group).agg(slim.alias(alias))


def bounded_top(
    totalled: DataFrame, group: Sequence[str], item: str, measure: str, n: int, alias: str, measure_alias: str, more: str = "more_ties"
) -> DataFrame:
    """One array of at most ``n`` (item, measure) structs per group, as ``collect_top``, and how many further items share a kept rank.

    Ties beyond the ``n``-th entry are counted instead of listed, so that no group's list outgrows its bound; the items
    themselves are the rows of ``keep_top``. Each task sends at most ``n`` rows of a group to the list, and one count.
    """
    lists = collect_top(keep_top(totalled, group, item, measure, n, "first"), group, item, measure, alias, measure_alias)
    last = keep_top(totalled, group, item, measure, n, "first").groupBy(*group).agg(F.max_by(measure, RANK).alias("__cut"), F.count(F.lit(1)).alias("__listed"))

    def same(names: Sequence[str]):
        return reduce(and_, [F.col(name).eqNullSafe(F.col(own)) for name, own in zip(group, names)])

    cut = last.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)], "__cut", "__listed")
    keys = [f"__g{i}" for i in range(len(group))]
    # A null at the cut ranks last: then every item of the group shares a kept rank.
    at_least = totalled.join(cut, same(keys)).filter(F.col("__cut").isNull() | (F.col(measure) >= F.col("__cut")))
    ties = at_least.groupBy(*keys).agg((F.count(F.lit(1)) - F.max("__listed")).alias(more))
    return lists.join(ties, same(keys)).drop(*keys)
