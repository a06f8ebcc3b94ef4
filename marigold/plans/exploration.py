"""Looking at a stored table, as jobs: each reads one table, computes, and writes what it found or reports it.

``source`` is a CSV file or a Parquet folder below the base, told apart by its name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from marigold.operators import explore
from marigold.plans.jobs import JobReport, Layout
from marigold.sources.sinks import export_csv, write_parquet
from marigold.sources.tables import if_exists, read_table

SHOWN = 500


def _found(spark: SparkSession, layout: Layout, source: str) -> DataFrame | None:
    path = layout.raw(source)
    return if_exists(lambda: read_table(spark, path, infer=True) if path.lower().rstrip("/").endswith(".csv") else read_table(spark, path))


def _table_job(job: str, plan: Callable[..., DataFrame]) -> Callable[..., JobReport]:
    """A job that writes ``plan(table, ...)`` to ``target``: CSV if it is called so, else Parquet."""

    def run(spark: SparkSession, layout: Layout, source: str, target: str, **options) -> JobReport:
        table = _found(spark, layout, source)
        if table is None:
            return JobReport(job, "missing", findings={"source": source})
        result, path = plan(table, **options), layout.raw(target)
        written = export_csv(explore.readable(result), path) if target.endswith(".csv") else write_parquet(result, path)
        return JobReport(job, "done", None, written)

    return run


def preview(spark: SparkSession, layout: Layout, source: str, shown: int = SHOWN) -> JobReport:
    """The first rows of a table, lists of items made readable, in the report itself."""
    table = _found(spark, layout, source)
    if table is None:
        return JobReport("preview", "missing", findings={"source": source})
    rows = [row.asDict() for row in explore.preview(table, shown).collect()]
    return JobReport("preview", "done", None, None, {"columns": explore.describe_columns(table), "rows": rows})


def metric_cards(spark: SparkSession, layout: Layout, source: str) -> JobReport:
    """Label, headline and spread of the first four numeric columns, in the report itself."""
    table = _found(spark, layout, source)
    if table is None:
        return JobReport("metric_cards", "missing", findings={"source": source})
    cards = [row.asDict() for row in explore.metric_cards(table).collect()]
    return JobReport("metric_cards", "done", None, None, {"cards": cards})


def _filtered(table: DataFrame, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Rows with one of the values, given as text; ``null`` stands for a missing one. Without values, the first five."""
    if values is None:
        return explore.filter_values(table, column)
    kind = table.schema[column].dataType
    cast = [None if v == "null" else v for v in values]
    one = table.sparkSession.createDataFrame([(v,) for v in cast], "v string").selectExpr(f"cast(v as {kind.simpleString()}) as v")
    return explore.filter_values(table, column, [row.v for row in one.collect()])


EXPLORATION: dict[str, Callable[..., JobReport]] = {
    "preview": preview,
    "metric_cards": metric_cards,
    "bar_data": _table_job("bar_data", lambda table, x, y, color=None: explore.bar_data(table, x, y, color)),
    "share_data": _table_job("share_data", lambda table, x, y: explore.share_data(table, x, y)),
    "line_data": _table_job("line_data", lambda table, x, y, color=None: explore.line_data(table, x, y, color)),
    "scatter_data": _table_job("scatter_data", lambda table, x, y, color=None, points=5_000: explore.scatter_sample(table, x, y, color, points)),
    "corr_matrix": _table_job("corr_matrix", lambda table: explore.corr_matrix(table)),
    "distinct_values": _table_job("distinct_values", lambda table, column: explore.distinct_values(table, column)),
    "filter_values": _table_job("filter_values", _filtered),
}
# What each job takes besides --source and --target.
OPTIONS = {
    "preview": {"shown"},
    "metric_cards": set(),
    "bar_data": {"x", "y", "color"},
    "share_data": {"x", "y"},
    "line_data": {"x", "y", "color"},
    "scatter_data": {"x", "y", "color", "points"},
    "corr_matrix": set(),
    "distinct_values": {"column"},
    "filter_values": {"column", "values"},
}
