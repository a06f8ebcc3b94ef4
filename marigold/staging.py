"""Places for data that a plan has to materialise: the checkpoint folder and scratch tables.

Both live in the shared folder named by ``spark.checkpoint.dir``, so that they outlive any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the setting by which shuffle files go with the query that made them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run within leave no shuffle files. By default these stay until the driver happens to collect its garbage,
    so that a job of many writes holds the shuffles of all of them on disk."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session without one gets a temporary folder; anywhere else a missing setting is an
    error, because a machine-local folder is lost with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="marigold-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that a plan writes and reads back."""
    return f"{shared_folder(spark)}/marigold-{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read the result from the shared folder afterwards.

    For *reduced* intermediates that a plan uses more than once, where evaluating twice would mean
    scanning the fact table twice. One pass: the checkpoint is written while it is computed.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def delete_folder(spark: SparkSession, path: str, parent: bool = False) -> None:
    """Delete a folder (or, with ``parent``, the one it lies in) in whatever store it is; a missing one is no error."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder = folder.getParent() if parent else folder
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


class Staging:
    """Tables staged for one job, deleted when it ends: ``with Staging(spark) as share: ... share(df)``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Staging:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "staged")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete_folder(self.spark, path, parent=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it from there: compressed, column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
