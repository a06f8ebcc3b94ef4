"""What a write leaves behind, and what a typed write converts."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from marigold.sources.sinks import export_csv, write_parquet
from marigold.sources.tables import read_csv, read_parquet
from marigold.sources.typed import typed, write_typed
from marigold.staging import SHUFFLE_CLEANUP, passing_shuffles

SCHEMA = {"n": T.IntegerType(), "price": T.DecimalType(6, 2), "rate": T.DoubleType(), "day": T.DateType()}


def _shuffles(spark) -> set[Path]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {file for folder in folders for file in Path(str(folder)).glob("*/shuffle_*.data")}


def _texts(spark):
    rows = [("1", "1.50", "2.5", "2024-01-01"), ("x", "1.50", "2.5", "2024-01-02"), ("3.7", "1.505", "2.5", "2024-01-03"), (" 4 ", "", "1e400", None)]
    return spark.createDataFrame(rows, "n string, price string, rate string, day string")


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffles(spark)
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
    assert write_parquet(rows, f"{tmp_path}/t", ["part"]).rows == 1000
    until = time.time() + 20
    while (left := _shuffles(spark) - before) and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert not left
    assert read_parquet(spark, f"{tmp_path}/t").count() == 1000


@pytest.mark.parametrize("own", ["false", "true"])
def test_the_session_has_its_own_setting_again(spark, own):
    found = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, own)
    try:
        with pytest.raises(RuntimeError), passing_shuffles(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            raise RuntimeError
        assert spark.conf.get(SHUFFLE_CLEANUP) == own
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, found)


def test_packed_text_is_smaller_and_reads_the_same(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.lit("the same text in all rows").alias("text"), F.lit(None).cast("string").alias("none"))
    sizes = {}
    for name, options in (("plain.csv", {}), ("packed.csv", {"compression": "gzip"})):
        export_csv(rows, f"{tmp_path}/{name}", **options)
        sizes[name] = sum(file.stat().st_size for file in (tmp_path / name).glob("part-*"))
        back = read_csv(spark, f"{tmp_path}/{name}", rows.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert sizes["packed.csv"] < sizes["plain.csv"] / 2


def test_the_sales_written_as_text_are_packed(spark, sf_dir):
    from workload.job_catalog import _masters

    layout, reports = _masters(spark, sf_dir)
    for name in ("products.csv", "Festival_Sales.csv"):
        parts = list(Path(layout.raw(name).removeprefix("file:")).glob("part-*"))
        assert parts and all(part.suffix == ".gz" for part in parts)
    assert [r.status for r in reports] == ["done", "done", "missing"]


@pytest.mark.parametrize("among", [None, ["n"], ["n", "price", "rate"]])
def test_faults_are_the_same_however_they_are_filtered(spark, among):
    texts = _texts(spark) if among != ["n"] else _texts(spark).filter("n in ('1', 'x')")
    found = typed(texts, SCHEMA).faults(among).select("n", "price", "rate", F.expr("transform(faults, f -> f.column || ' ' || f.text || ' ' || f.fault)").alias("faults"))
    bad = [(None, "1.50", 2.5, ["n x failed"])]
    if among != ["n"]:
        bad += [(4, None, None, ["rate 1e400 failed"]), (4, "1.51", 2.5, ["n 3.7 rounded", "price 1.505 rounded"])]
    got = sorted(((r.n, r.price and str(r.price), r.rate, r.faults) for r in found.collect()), key=str)
    assert got == sorted(bad, key=str)


def test_rows_are_filtered_before_the_other_columns_are_converted(spark):
    """If one column of four has faults, only its texts are converted in all rows."""
    plan = typed(_texts(spark), SCHEMA).faults(["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert "as date" in plan and "as date" not in plan.partition("Filter")[2]


def test_quarantine_and_account_of_a_typed_write(spark, tmp_path):
    made = write_typed(typed(_texts(spark), SCHEMA), f"{tmp_path}/t", f"{tmp_path}/q")
    assert made.faults == {"n": {"failed": 1, "rounded": 1}, "price": {"rounded": 1}, "rate": {"failed": 1}}
    assert (made.written.rows, made.quarantine.rows) == (4, 3)
