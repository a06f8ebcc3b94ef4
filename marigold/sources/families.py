"""Families of CSV files whose headers differ: other orders, missing and further columns.

Spark fills the columns of a CSV by position, and takes the header of one file for that of all. Here the header of every
file is found first, files with the same header are read by one scan, and the scans are brought together by name.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marigold.functions.text import FILE_STEM
from marigold.sources.files import MOST_PATHS, with_file_key

PATH = "__path"


def headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, header``: the first line that is not empty of each file; files without one are left out.

    The files are read as lines, without taking them apart, and of files in several splits only the first one counts;
    one line per file leaves its task.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    at_start = lines.filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
    numbered = at_start.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    return numbered.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def names_in(header: str, sep: str = ",") -> list[str]:
    """The column names of a header line; a byte order mark and blanks around names are not part of them."""
    return [name.strip() for name in next(csv.reader([header.lstrip("\ufeff")], delimiter=sep))]


def plain_path(path: str) -> str:
    """A path of Spark's metadata as a reader takes it: escapes decoded, signs that a glob would read escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path))


def _text(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _checked(names: list[str], header: str) -> list[str]:
    if len(set(names)) < len(names) or "" in names:
        raise ValueError(f"a header must name every column once: {header!r}")
    return names


def read_family(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    key: str | None = None,
    pattern: str = FILE_STEM,
    underscore_as_space: bool = False,
    most_paths: int = MOST_PATHS,
    **options: str,
) -> DataFrame:
    """All files as one table of text: ``columns`` first (null where a file lacks one), then further ones by name.

    ``key`` adds the key that each file's name carries. Up to ``most_paths`` files, each group of files with the same
    header is read from a list of paths; beyond, one scan over all files reads columns by position, and rows find their
    header by a join on the path, so that the driver holds one line per different header and no list of files.
    """
    reader = spark.read.options(**{"header": True, "enforceSchema": True, **options})
    found = headers(spark, paths)
    groups = found.groupBy("header").agg(F.count(F.lit(1)).alias("files")).collect()
    named = {row.header: _checked(names_in(row.header, options.get("sep", ",")), row.header) for row in groups}
    more = sorted({name for names in named.values() for name in names} - set(columns))
    wanted = [*columns, *more]

    def keyed(scan: DataFrame) -> DataFrame:
        return with_file_key(scan, key, pattern, underscore_as_space) if key else scan

    if not groups:
        return spark.createDataFrame([], _text([*wanted, *([key] if key else [])]))
    if sum(row.files for row in groups) <= most_paths:
        lists: dict[str, list[str]] = {}
        for row in found.toLocalIterator():
            lists.setdefault(row.header, []).append(plain_path(row.path))
        scans = []
        for header in sorted(lists):
            scan = keyed(reader.schema(_text(named[header])).csv(sorted(lists[header])))
            scans.append(scan.select(*[F.col(f"`{c}`") if c in named[header] else F.lit(None).cast("string").alias(c) for c in wanted], *([key] if key else [])))
        return reduce(DataFrame.unionByName, scans)
    return _by_position(reader, paths, found, named, wanted, keyed, key)


def _by_position(
    reader, paths: str | Sequence[str], found: DataFrame, named: dict[str, list[str]], wanted: Sequence[str], keyed: Callable, key: str | None
) -> DataFrame:
    """One scan of all files by position; each row takes its names from the header of its file."""
    places = [f"c{i}" for i in range(max(map(len, named.values())))]
    scan = keyed(reader.schema(_text([f"__{p}" for p in places])).csv(paths if isinstance(paths, str) else list(paths)))
    scan = scan.withColumn(PATH, F.col("_metadata.file_path"))
    rows = scan.join(found.withColumnRenamed("path", "__file"), F.col(PATH) == F.col("__file"))

    def value(name: str):
        held = [(header, names.index(name)) for header, names in sorted(named.items()) if name in names]
        chain = F.when(F.lit(False), F.lit(None).cast("string"))
        for header, i in held:
            chain = chain.when(F.col("header") == header, F.col(f"__c{i}"))
        return chain.alias(name)

    return rows.select(*[value(name) for name in wanted], *([key] if key else []))
