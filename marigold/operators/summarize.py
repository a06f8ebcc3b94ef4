"""Grouped sums, means and counts, in one step or in two.

A mean is carried as (sum, count) until the last step. That makes every summary mergeable: a fine
pre-aggregate can be rolled up to any coarser grain without averaging averages, and plans can aggregate
before a join or share one scan of the fact table. Sums of decimals, and of doubles whose decimal digits are
declared, are exact and do not depend on the order in which partitions arrive; they become doubles only in
the reported columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marigold.functions.exact import high_sum, joined, low_sum, minor_digits_of, minor_units

_ROWS = "__rows"
_STATE = re.compile(r"__(?:rows$|sum_|count_|tally_|high\d_|low\d_)")


@dataclass(frozen=True)
class Measures:
    """What to report per group: output name to input column for sums and means, a name for the row count.

    ``tallies`` names conditions whose rows are counted beside the measures, for the report of a job.
    ``minor_digits`` declares how many decimal digits the double inputs have, for all or column by column, which
    makes their sums exact. A value with more digits than declared is an error.
    """

    sums: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    rows: str | None = None
    minor_digits: int | Mapping[str, int] | None = None
    tallies: Mapping[str, Column] = field(default_factory=dict)

    def digits_of(self, column: str) -> int | None:
        return self.minor_digits.get(column) if isinstance(self.minor_digits, Mapping) else self.minor_digits

    @property
    def inputs(self) -> list[str]:
        return list(dict.fromkeys([*self.sums.values(), *self.means.values()]))

    def state(self, df: DataFrame) -> list[Column]:
        """Aggregates over raw rows."""
        kinds = {f.name: f.dataType for f in df.select(*self.inputs).schema}
        state = []
        for column in self.inputs:
            digits = minor_digits_of(kinds[column], self.digits_of(column))
            if digits is None:
                state.append(F.sum(column).alias(f"__sum_{column}"))
            else:
                units = minor_units(F.col(column), kinds[column], digits)
                state += [high_sum(units).alias(f"__high{digits}_{column}"), low_sum(units).alias(f"__low{digits}_{column}")]
        state += [F.count(c).alias(f"__count_{c}") for c in dict.fromkeys(self.means.values())]
        if self.rows:
            state.append(F.count(F.lit(1)).alias(_ROWS))
        state += [F.count_if(condition).alias(f"__tally_{name}") for name, condition in self.tallies.items()]
        return state

    def report(self, state: DataFrame) -> list[Column]:
        """State columns to reported columns."""
        kinds = {f.name: f.dataType for f in state.schema}
        shown = []
        for name, column in self.sums.items():
            exact = isinstance(kinds.get(f"__sum_{column}", T.DecimalType()), T.DecimalType)
            total = total_of(state, column)
            shown.append((total.cast("double") if exact else total).alias(name))
        if self.rows:
            shown.append(F.col(_ROWS).alias(self.rows))
        for name, column in self.means.items():
            total = total_of(state, column).cast("double")
            shown.append(F.try_divide(total, F.col(f"__count_{column}")).alias(name))
        return shown + [F.col(f"`__tally_{name}`").alias(name) for name in self.tallies]


def total_of(state: DataFrame, column: str, take: Callable[[str], Column] = F.col) -> Column:
    """The sum of ``column`` held by state rows; with ``take=F.sum``, an aggregate that merges several of them."""
    for name in state.columns:
        split = re.fullmatch(rf"__high(\d)_{re.escape(column)}", name)
        if split:
            return joined(take(name), take(f"__low{split[1]}_{column}"), int(split[1]))
    return take(f"__sum_{column}")


def preaggregate(df: DataFrame, keys: Sequence[str | Column], measures: Measures) -> DataFrame:
    """One state row per distinct ``keys``."""
    return df.groupBy(*keys).agg(*measures.state(df))


def roll_up(state: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """State rows to coarser state rows: every state column is a sum, so merging adds up."""
    return state.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in state.columns if _STATE.match(name)])


def reported(state: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """State rows to the columns a reader sees."""
    return state.select(*keys, *measures.report(state))


def summarize(df: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """Sums, means and row count per group: one partial and one final hash aggregate around one shuffle."""
    return reported(preaggregate(df, keys, measures), keys, measures)


def totals(df: DataFrame, keys: Sequence[str], column: str, alias: str, minor_digits: int | None = None) -> DataFrame:
    """The sum of one column per group. An exact sum stays a decimal, so that it can be ranked or added up further."""
    state = preaggregate(df, keys, Measures(sums={alias: column}, minor_digits=minor_digits))
    return state.select(*keys, total_of(state, column).alias(alias))
