"""Repeated windows are found whatever windows of like hashes stand between them."""

from __future__ import annotations

import brute
from pyspark.sql import functions as F

from marigold.llm import quality_rules


def test_windows_with_like_hashes_hide_no_repeat(spark):
    # Different windows whose hashes agree in their lowest 40 bits.
    windows = spark.range(6_000_000).select("id", F.xxhash64(F.lit("a"), F.lit("b"), F.col("id").cast("string")).bitwiseAND((1 << 40) - 1).alias("low"))
    pairs = windows.groupBy("low").agg(F.min("id").alias("x"), F.max("id").alias("y")).filter("x <> y").limit(3).collect()
    assert pairs
    texts = [f"a b {r['x']} q a b {r['y']} r a b {r['x']}" for r in pairs]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.measure(df).collect()}
    assert got == {i: brute.quality(t)[4] for i, t in enumerate(texts)} == dict.fromkeys(got, 6)
