"""One writer for all formats, with row counts taken in the same action as the write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

from marigold.staging import passing_shuffles


@dataclass(frozen=True)
class Written:
    """What a write did."""

    path: str
    rows: int
    schema: str
    metrics: dict = field(default_factory=dict)


def spread_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition folder together, so that each task does not write a file in every folder.

    A rebalance, not a repartition: adaptive execution splits a folder that holds too much for one task and
    merges small ones, so a month with a third of all rows is still written by many tasks.
    """
    return df.hint("rebalance", *columns) if columns else df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
    header: bool = True,
    metrics: Mapping[str, Column] | None = None,
    hidden: Sequence[str] = (),
    keep: Column | None = None,
    **options: str,
) -> Written:
    """Overwrite ``path`` and count what is written, in one action.

    ``metrics`` are further aggregates to observe on the way; they may use ``hidden`` columns, which are
    observed but not written. Rows that ``keep`` is not true for are observed too, but neither written nor counted as
    rows. The observation sits behind the last shuffle: there each row counts once
    even when lost executors make tasks run again, which does not hold for counts taken before a shuffle.
    With ``dynamic`` only the partition folders that occur in ``df`` are replaced. ``options`` are those of the format.
    """
    observation = Observation()
    wanted = [value.alias(name) for name, value in (metrics or {}).items()]
    tallied = spread_by(df, partition_by).observe(observation, (F.count(F.lit(1)) if keep is None else F.count_if(keep)).alias("rows"), *wanted)
    visible = (tallied if keep is None else tallied.filter(keep)).drop(*hidden)
    writer = visible.write.mode("overwrite").format(fmt).options(**options)
    if fmt == "csv":
        writer = writer.option("header", header)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with passing_shuffles(df.sparkSession):
        writer.save(path)
    seen = dict(observation.get)
    return Written(path, seen.pop("rows"), visible.schema.simpleString(), seen)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), **kwargs) -> Written:
    return write_table(df, path, "parquet", partition_by, **kwargs)


def export_csv(df: DataFrame, path: str, header: bool = True, **options: str) -> Written:
    """Rows as CSV text. Nested columns must be made readable first."""
    return write_table(df, path, "csv", header=header, **options)
