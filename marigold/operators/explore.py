"""Looking at a table: previews, headline numbers, chart data, correlations, value filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from marigold.functions.text import RUPEE, items_as_text, label_of, two_decimals, whole_number
from marigold.operators.checks import date_like_columns, numeric_columns
from marigold.operators.summarize import totals

# Fragments of a column name that make its headline a sum; all others show a mean.
MONEY_FRAGMENT = "revenue"
SUMMED_FRAGMENTS = ("units", "products", "sold")


def _is_item_list(kind: T.DataType) -> bool:
    return (
        isinstance(kind, T.ArrayType)
        and isinstance(kind.elementType, T.StructType)
        and len(kind.elementType) == 2
        and isinstance(kind.elementType[1].dataType, T.NumericType)
    )


def readable(df: DataFrame) -> DataFrame:
    """Arrays of (item, measure) structs as text; other columns unchanged."""
    shown = []
    for column in df.schema:
        if _is_item_list(column.dataType):
            item, measure = column.dataType.elementType.names
            shown.append(items_as_text(F.col(column.name), item, measure).alias(column.name))
        else:
            shown.append(F.col(column.name))
    return df.select(*shown)


def preview(df: DataFrame, n: int = 500) -> DataFrame:
    """The first ``n`` rows for a person to look at. The cut comes before the formatting."""
    return readable(df.limit(n))


def first_rows(df: DataFrame, n: int = 3) -> list[Row]:
    """The first ``n`` rows on the driver. Over a plain scan Spark opens one partition and stops there."""
    return df.limit(n).collect()


def describe_columns(df: DataFrame) -> list[tuple[int, str, str]]:
    """(position, name, type) of every column; taken from the schema, no job runs."""
    return [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]


def headline_kind(column: str) -> str:
    """``money`` or ``sum`` for columns that add up by their name, else ``mean``."""
    name = column.lower()
    if MONEY_FRAGMENT in name:
        return "money"
    return "sum" if any(part in name for part in SUMMED_FRAGMENTS) else "mean"


def metric_cards(df: DataFrame, k: int = 4, kinds: Mapping[str, str] | None = None) -> DataFrame:
    """One row per numeric column, the first ``k`` of them: label, headline text, spread text.

    The spread is the sample standard deviation, null for a table of one row. ``kinds`` overrides the
    choice of ``money``, ``sum`` or ``mean`` per column. One aggregate over the table serves all cards.
    """
    columns = numeric_columns(df)[:k]
    if not columns:
        raise ValueError("no numeric column")
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for i, column in enumerate(columns):
        aggregates += [
            F.sum(column).alias(f"__sum{i}"),
            F.count(column).alias(f"__count{i}"),
            F.stddev_samp(F.col(column).cast("double")).alias(f"__sd{i}"),
        ]
    cards = []
    for i, column in enumerate(columns):
        kind = (kinds or {}).get(column) or headline_kind(column)
        total = F.coalesce(F.col(f"__sum{i}").cast("double"), F.lit(0.0))
        value = {
            "money": F.concat(F.lit(RUPEE), whole_number(total)),
            "sum": whole_number(total),
            "mean": two_decimals(F.try_divide(total, F.col(f"__count{i}"))),
        }[kind]
        cards.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(column).alias("column_name"),
                F.lit(label_of(column)).alias("label"),
                F.lit(kind).alias("kind"),
                value.alias("value"),
                F.when(F.col("__rows") > 1, two_decimals(F.col(f"__sd{i}"))).alias("spread"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*cards)))


def _reported_sum(df: DataFrame, total: str) -> Column:
    exact = isinstance(df.schema[total].dataType, T.DecimalType)
    return F.col(total).cast("double") if exact else F.col(total)


def bar_data(df: DataFrame, x: str, y: str, color: str | None = None, minor_digits: int | None = None) -> DataFrame:
    """Height of each bar: the sum of ``y`` per ``x``, or per (``x``, ``color``) for stacked bars."""
    keys = [x] if color in (None, x) else [x, color]
    bars = totals(df, keys, y, y, minor_digits)
    return bars.select(*keys, _reported_sum(bars, y).alias(y))


def share_data(
    df: DataFrame, names: str, values: str, share: str = "share_pct", minor_digits: int | None = None
) -> DataFrame:
    """Sum of ``values`` per name and its percentage of the whole. Rows without a name are left out.

    The whole is a scalar subquery over the grouped rows: Spark reuses their shuffle, so the table is read
    once and no window pulls the groups into one task.
    """
    slices = totals(df.filter(F.col(names).isNotNull()), [names], values, values, minor_digits)
    whole = slices.agg(F.sum(values).cast("double")).scalar()
    percent = F.try_divide(F.col(values).cast("double"), whole) * 100
    return slices.select(names, _reported_sum(slices, values).alias(values), percent.alias(share))


def line_data(df: DataFrame, x: str, y: str, group: str | None = None) -> DataFrame:
    """Points of a line chart over a date-like column, as they are, ordered within each line."""
    if x not in date_like_columns(df):
        raise ValueError(f"{x} is not a date-like column")
    lines = [group] if group else []
    return df.select(*dict.fromkeys([*lines, x, y])).orderBy(*lines, x, y)


def scatter_data(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Points of two different numeric columns."""
    numeric = numeric_columns(df)
    if x == y or x not in numeric or y not in numeric:
        raise ValueError("x and y must be two different numeric columns")
    return df.select(*dict.fromkeys([x, y, *([color] if color else [])]))


# Bits of a row's place by which ``scatter_sample`` counts rows before it ranks any.
SAMPLE_BITS = 16
PLACE_BITS = 52
# Rows from which on a colour is cut down before it is shuffled.
LARGE_COLOUR = 100_000


def _place_of(keys: Sequence[str]) -> Column:
    """A number of 52 bits that depends on the values of the keys alone, null apart from the empty text."""
    named = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *named).cast("binary")), 1, PLACE_BITS // 4), 16, 10).cast("long")


def scatter_sample(
    df: DataFrame, x: str, y: str, color: str | None = None, n: int = 5_000, keys: Sequence[str] | None = None, share: str = "share"
) -> DataFrame:
    """At most ``n`` points of each colour: all of them up to ``n``, else those that come first in an order by hash.

    ``keys`` tell rows apart (the points' own values by default, where equal points then stand or fall together); the
    sample depends on their values alone, not on how the rows are spread over tasks. ``share`` says which share of the
    colour's rows the points stand for, so that a chart can scale counts back.

    Rows are first counted by the upper bits of their place in that order. These counts say how far the first ``n`` of
    each large colour reach, and only rows up to there, ``n`` and a 65,536th of the colour or so, are shuffled and
    ranked. Large colours are few (at most one for ``LARGE_COLOUR`` rows), so their limits are broadcast: a join by
    colour would bring all rows of a colour into one task. Rows of smaller colours are ranked as they are.
    """
    scatter_data(df, x, y, color)
    if n < 1:
        raise ValueError("a sample needs room for one point")
    told = [*dict.fromkeys([x, y, *([color] if color else [])])]
    chosen = list(keys) if keys is not None else told
    rows = df.select(*told, *[F.col(k).alias(f"__k{i}") for i, k in enumerate(chosen)], _place_of(chosen).alias("__at"))
    rows = rows.withColumns({"__hue": F.col(color) if color else F.lit(0), "__slot": F.shiftright("__at", PLACE_BITS - SAMPLE_BITS)})
    counts = rows.groupBy("__hue", "__slot").agg(F.count(F.lit(1)).alias("__here"))
    upto = F.sum("__here").over(Window.partitionBy("__hue").orderBy("__slot"))
    limits = counts.withColumn("__upto", upto).groupBy(F.col("__hue").alias("__its"))
    limits = limits.agg(F.sum("__here").alias("__all"), F.min(F.when(F.col("__upto") >= n, F.col("__slot"))).alias("__last"))
    if color:
        large = limits.filter(F.col("__all") > max(n, LARGE_COLOUR)).select(F.col("__its").alias("__large"), "__last")
        near = rows.join(F.broadcast(large), F.col("__hue").eqNullSafe(F.col("__large")), "left").drop("__large")
    else:
        near = rows.withColumn("__last", limits.select("__last").scalar())
    near = near.filter(F.col("__last").isNull() | (F.col("__slot") <= F.col("__last")))
    order = ["__at", *[f"__k{i}" for i in range(len(chosen))], *told]
    first = near.withColumn("__rank", F.row_number().over(Window.partitionBy("__hue").orderBy(*order))).filter(F.col("__rank") <= n)
    if color:
        first = first.join(limits, F.col("__hue").eqNullSafe(F.col("__its")))
    else:
        first = first.withColumn("__all", limits.select("__all").scalar())
    return first.select(*told, F.least(F.lit(1.0), F.lit(float(n)) / F.col("__all")).alias(share))


def _as_shown(df: DataFrame, column: str) -> Column:
    """A value as text; of lists and maps only how many entries they have, of structs their JSON."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.concat(F.lit(f"{kind.typeName()} of "), F.nullif(F.size(value), F.lit(-1)).cast("string"))
    return F.to_json(value) if isinstance(kind, (T.StructType, T.VariantType)) else value.cast("string")


def first_values(tables: Mapping[str, DataFrame], order: Mapping[str, Sequence[str]], n: int = 3) -> DataFrame:
    """The first ``n`` rows of many tables in one plan, a row for each of their values.

    ``table_name, position, column_name, column_type, row_number, value``: every column of every table appears, with null
    row number and value if the table is empty. ``order`` names the columns that say which rows of a table come first.
    Nothing runs before the result is asked for, and no more than ``n`` rows of a table leave their tasks.
    """
    if not tables:
        raise ValueError("no table to look at")
    session = next(iter(tables.values())).sparkSession
    described = [(name, *column) for name, df in tables.items() for column in describe_columns(df)]
    columns = session.createDataFrame(described, "table_name string, position int, column_name string, column_type string")
    parts = []
    for name, df in tables.items():
        keys = [F.col(f"`{k}`").asc_nulls_first() for k in order[name]]
        first = df.orderBy(*keys).limit(n).withColumn("__row", F.row_number().over(Window.orderBy(*keys)))
        values = F.posexplode(F.array(*[_as_shown(df, c) for c in df.columns])).alias("at", "value")
        parts.append(first.select(F.lit(name).alias("of"), F.col("__row").alias("row_number"), values))
    found = reduce(DataFrame.unionByName, parts)
    same = (F.col("table_name") == F.col("of")) & (F.col("position") == F.col("at"))
    return columns.join(found, same, "left").select(*columns.columns, "row_number", "value")


def _moments(k: int) -> Callable:
    """Per task one row for each pair of columns: count, means, and centred sums of squares and products.

    A batch is shifted by its first values before its products are formed, which leaves nothing to cancel in a
    constant column; batches are merged by their means.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, square, cross = (np.zeros((k, k)) for _ in range(4))  # mean[i, j]: of i, where both are present
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) if len(batch) else np.zeros((0, k))
            there = ~np.isnan(x)
            if not there.any():
                continue
            shift = np.where(there.any(axis=0), x[there.argmax(axis=0), np.arange(k)], 0.0)
            x = np.where(there, x - shift, 0.0)
            there = there.astype(float)
            more = there.T @ there
            sums = x.T @ there
            with np.errstate(divide="ignore", invalid="ignore"):
                own = np.where(more > 0, sums / more, 0.0)
                share = np.where(n + more > 0, more / (n + more), 0.0)
            squares, products = (x * x).T @ there - sums * own, x.T @ x - sums * own.T
            own = own + shift[:, None]
            gap = np.where(n > 0, own - mean, 0.0)
            square += squares + gap * gap * n * share
            cross += products + gap * gap.T * n * share
            mean = np.where(n > 0, mean + gap * share, own)
            n += more
        i, j = np.triu_indices(k)
        table = (i.astype(np.int32), j.astype(np.int32), n[i, j], mean[i, j], mean[j, i], square[i, j], square[j, i], cross[i, j])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in table], names=["i", "j", "n", "mx", "my", "xx", "yy", "xy"])

    return run


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns as rows (x, y, r), in both orders and with itself.

    Each pair uses the rows where both are present; NaN counts as missing. A column that does not vary gives
    null, where Spark's own ``corr`` would fail.

    One scan, however many columns: every task turns its rows into partial moments of all pairs by matrix products,
    and only one row per pair and task is shuffled. They are added up around the least of the tasks' means.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if len(names) < 2:
        raise ValueError("a correlation matrix needs two or more numeric columns")
    missing = F.lit(float("nan"))
    wide = df.select(*[F.coalesce(F.col(name).cast("double"), missing).alias(f"c{i}") for i, name in enumerate(names)])
    schema = "i int, j int, n double, mx double, my double, xx double, yy double, xy double"
    parts = wide.mapInArrow(_moments(len(names)), schema)
    pair = Window.partitionBy("i", "j")
    seen = F.col("n") > 0
    parts = parts.withColumns({"dx": F.col("mx") - F.min(F.when(seen, F.col("mx"))).over(pair), "dy": F.col("my") - F.min(F.when(seen, F.col("my"))).over(pair)}).filter(seen)
    sums = parts.groupBy("i", "j").agg(
        *[F.sum(a).alias(a) for a in ("n", "xx", "yy", "xy")],
        *[F.sum(F.col("n") * b).alias(a) for a, b in (("sx", F.col("dx")), ("sy", F.col("dy")), ("sxx", F.col("dx") * F.col("dx")), ("syy", F.col("dy") * F.col("dy")), ("sxy", F.col("dx") * F.col("dy")))],
    )
    n = F.col("n")
    vx, vy, cov = (F.col(a) + F.col(f"s{a}") - F.col(f"s{a[0]}") * F.col(f"s{a[1]}") / n for a in ("xx", "yy", "xy"))
    sums = sums.select("i", "j", vx.alias("vx"), vy.alias("vy"), cov.alias("cov"))
    varies = (F.col("vx") > 0) & (F.col("vy") > 0)
    r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.col("cov") / F.sqrt(F.col("vx")) / F.sqrt(F.col("vy")))
    r = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    pairs = df.sparkSession.createDataFrame([(i, j, names[i], names[j]) for i in range(len(names)) for j in range(i, len(names))], "i int, j int, a string, b string")
    found = pairs.join(sums, ["i", "j"], "left").select("i", "j", "a", "b", r.alias("r"))
    both = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y"), "r"), F.struct(F.col("b").alias("x"), F.col("a").alias("y"), "r"))
    return found.select(F.inline(F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Each value of a column once, null included."""
    return df.select(column).distinct()


def default_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The values preselected for a filter: the first ``n`` distinct ones in ascending order."""
    return distinct_values(df, column).orderBy(F.col(column).asc_nulls_last()).limit(n)


def filter_values(df: DataFrame, column: str, values: Iterable | None = None, n: int = 5) -> DataFrame:
    """Rows whose ``column`` is one of ``values``; None among them stands for null.

    Without ``values`` the default selection is looked up first: at most ``n`` values come to the driver,
    and the filter is then a literal list that reaches the scan.
    """
    if values is None:
        values = [row[0] for row in default_values(df, column, n).collect()]
    chosen = list(values)
    plain = [value for value in chosen if value is not None]
    keep = F.col(column).isin(plain)
    if len(plain) < len(chosen):
        keep = keep | F.col(column).isNull()
    return df.filter(keep)
