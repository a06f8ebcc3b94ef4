"""What the entry point offers of the document operators."""

from __future__ import annotations

from __spark_entry__ import oracle_sql, queries


def test_each_of_the_thirteen_operators_has_one_query():
    numbered = sorted(int(name[2:].split("_")[0]) for name in queries() if name.startswith("op") and name[2:3].isdigit())
    assert numbered == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries()) and "pipeline" in queries()
