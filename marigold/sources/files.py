"""Families of files: keys taken from file names, files chosen by a list of names, listings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from marigold.functions.text import FILE_STEM, clean_name, file_stem_for, key_in_path
from marigold.sources.tables import uri

# The file types a listing shows.
DATA_SUFFIXES = (".parquet", ".csv")
# So many chosen files at most are handed to a reader by their paths; more are found by their key during one scan.
MOST_PATHS = 10_000


def with_file_key(scan: DataFrame, name: str, pattern: str = FILE_STEM, underscore_as_space: bool = False) -> DataFrame:
    """Add the key that the file name of each row carries. ``scan`` must come straight from a reader."""
    return scan.withColumn(name, key_in_path(F.col("_metadata.file_path"), pattern, underscore_as_space))


def list_files(spark: SparkSession, prefix: str, suffixes: Sequence[str] = DATA_SUFFIXES, recursive: bool = True) -> DataFrame:
    """Every file below ``prefix`` (or, not ``recursive``, in it) with one of the suffixes: path, length, modification time.

    Only file status is read: the content column is pruned from the scan.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(prefix)
        .select("path", "length", "modificationTime")
    )
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.endswith(F.col("path"), F.lit(suffix))
    return found.filter(wanted)


def listed_names(names: DataFrame, column: str) -> DataFrame:
    """The usable names of a list, each once, with their spelling in file names."""
    name = clean_name(F.col(column))
    return names.select(name.alias("name")).filter(F.col("name").isNotNull()).distinct().withColumn("stem", file_stem_for(F.col("name")))


def match_names(names: DataFrame, column: str, keyed: DataFrame, key: str, path: str) -> DataFrame:
    """Each listed name with the path of its file: (name, key, path), nulls when there is none.

    The spelling with underscores wins; the exact name is the fallback.
    """
    wanted = listed_names(names, column)
    files = keyed.select(F.col(key).alias("key"), F.col(path).alias("path"))
    spelt = files.select(F.col("key").alias("spelt_key"), F.col("path").alias("spelt_path"))
    exact = files.select(F.col("key").alias("exact_key"), F.col("path").alias("exact_path"))
    found = wanted.join(spelt, F.col("stem") == F.col("spelt_key"), "left").join(
        exact, F.col("name") == F.col("exact_key"), "left"
    )
    return found.select(
        "name",
        F.coalesce("spelt_key", "exact_key").alias("key"),
        F.coalesce("spelt_path", "exact_path").alias("path"),
    )


def choose_files(
    spark: SparkSession, folder: str, names: DataFrame, column: str, pattern: str = FILE_STEM, recursive: bool = False
) -> DataFrame:
    """The files in ``folder`` itself (or, ``recursive``, below it) that a list of names asks for, one row per name."""
    listing = list_files(spark, uri(folder), (".csv",), recursive)
    keyed = listing.withColumn("key", key_in_path(F.col("path"), pattern))
    return match_names(names, column, keyed, "key", "path")


def chosen_paths(chosen: DataFrame) -> list[str]:
    """Paths of ``choose_files`` for a reader: file names only, which the driver plans its scan with anyway."""
    rows = chosen.filter(F.col("path").isNotNull()).select("path").distinct().toLocalIterator()
    return sorted(row.path for row in rows)


def read_chosen(
    read: Callable[[list[str], str], DataFrame],
    chosen: DataFrame,
    read_all: Callable[[str], DataFrame],
    key: str,
    underscore_as_space: bool = False,
    most_paths: int = MOST_PATHS,
) -> DataFrame | None:
    """The rows of the files of ``choose_files`` with their key; None if there is no such file.

    ``read`` scans a list of paths, ``read_all`` every file there is; both add the key of each file under the name they
    are given. Up to ``most_paths`` files come to the driver as a list, so that no other file is opened. Beyond, all
    files are scanned and rows are kept by their key: the driver then holds no list, however many names there are.
    """
    found = chosen.filter(F.col("path").isNotNull()).select("path", F.col("key").alias("__chosen")).distinct()
    some = sorted({row.path for row in found.limit(most_paths + 1).collect()})
    if not some:
        return None
    if len(some) <= most_paths:
        kept = read(some, "__key")
    else:
        kept = read_all("__key").join(found.select("__chosen").distinct(), F.col("__key") == F.col("__chosen"), "left_semi")
    shown = F.replace(F.col("__key"), F.lit("_"), F.lit(" ")) if underscore_as_space else F.col("__key")
    return kept.withColumn(key, shown).drop("__key")


def keep_listed(rows: DataFrame, key: str, names: DataFrame, column: str, listed: bool = True) -> DataFrame:
    """Rows whose key is on the list in either spelling, or with ``listed=False`` those whose key is not."""
    wanted = listed_names(names, column)
    spellings = wanted.select(F.explode(F.array_distinct(F.array("stem", "name"))).alias("__spelling")).distinct()
    return rows.join(spellings, F.col(key) == F.col("__spelling"), "left_semi" if listed else "left_anti")
