"""CSV and Parquet scans."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T


def uri(base: str, *keys: str) -> str:
    """Join a base URI and keys without doubled slashes."""
    return "/".join([base.rstrip("/"), *[key.lstrip("/") for key in keys]])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    by: str = "name",
    infer: bool = False,
    **options: str,
) -> DataFrame:
    """CSV files with a header row: one file, a glob, a folder or a list of files as one table.

    ``schema`` gives types. ``by="name"`` matches them to the header, which is one line read from one file;
    columns that the schema does not name stay text, and a file with another header is an error. ``by="position"`` ignores the names in the header, for
    files whose header is ambiguous. ``infer=True`` derives types from the data, which costs a second pass
    over all of it.
    """
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.options(**{"header": True, **options})
    if schema is None:
        return reader.option("inferSchema", infer).csv(paths)
    if by == "position":
        return reader.schema(schema).csv(paths)
    if by != "name":
        raise ValueError(f"by must be 'name' or 'position', not {by!r}")
    first = paths if isinstance(paths, str) else paths[:1]
    declared = {field.name: field.dataType for field in schema}
    header = reader.csv(first).columns
    typed = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in header])
    # Spark fills columns by position: a file whose header differs from the first one's must not be read silently.
    return reader.option("enforceSchema", False).schema(typed).csv(paths)


def read_parquet(spark: SparkSession, path: str | Sequence[str], partition_types: Mapping[str, str] | None = None) -> DataFrame:
    """A Parquet folder with its partition columns.

    Spark guesses the types of partition values from the folder names, so a state ``007`` comes back as
    the number 7; ``partition_types`` states them instead.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    if not partition_types:
        return df
    fields = [
        T.StructField(f.name, T.DataType.fromDDL(partition_types[f.name]) if f.name in partition_types else f.dataType)
        for f in df.schema
    ]
    return spark.read.schema(T.StructType(fields)).parquet(*paths)


def read_table(spark: SparkSession, path: str, **kwargs) -> DataFrame:
    """Load by extension: ``.csv`` as CSV, anything else as a Parquet folder."""
    return read_csv(spark, path, **kwargs) if path.rstrip("/").lower().endswith(".csv") else read_parquet(spark, path, **kwargs)


def if_exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` returns, or None when its path does not exist; every other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
