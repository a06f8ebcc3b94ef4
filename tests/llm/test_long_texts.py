"""Very long texts: their words become rows, with the results of shorter ones."""

from __future__ import annotations

from collections import Counter

import brute

from marigold.llm import quality_rules

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_long_and_short_way_agree(spark):
    hard = brute.hard(spark, clashes=False)
    whole = quality_rules.measure(hard, keep=("doc_id", "lang"))
    for long_chars in (-1, 20, 400):
        other = quality_rules.measure(hard, keep=("doc_id", "lang"), long_chars=long_chars)
        assert other.dtypes == whole.dtypes and rows(other) == rows(whole)


def test_long_way_with_clashing_names(spark):
    found = quality_rules.measure(brute.hard(spark), keep=("doc_id", "kept", "a.b", "n_lines"), long_chars=10)
    assert rows(found.select("doc_id", *BASE)) == Counter((d, *brute.quality(t)) for d, t, *_ in brute.HARD)


def test_a_text_of_a_million_words(spark):
    text = "\n".join(["one two three four five six seven eight nine ten.", *[f"a{i} b{i} c{i} d{i}." for i in range(100_000)]] * 2) + " end"
    found = quality_rules.measure(spark.createDataFrame([(1, text), (2, text), (3, "x " * 1_200_000)], "doc_id long, text string"))
    assert rows(found.select("doc_id", *BASE)) == Counter((d, *brute.quality(t)) for d, t in ((1, text), (2, text), (3, "x " * 1_200_000)))
