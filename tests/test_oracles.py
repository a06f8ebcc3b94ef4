"""Every query of the catalog against its SQL, value for value."""

from __future__ import annotations

from collections import Counter

import pytest

from workload.catalog import QUERIES
from workload.oracles import ORACLES

ROWS_ONLY = {"inspect_columns"}


def test_only_listings_and_nested_values_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.execute(ORACLES[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = Counter(theirs.fetchall())
    got = Counter(tuple(row[c] for c in columns) for row in ours.collect())
    assert sum(got.values()) == sum(expected.values())
    assert got == expected


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
