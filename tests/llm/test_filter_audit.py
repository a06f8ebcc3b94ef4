"""The audit against a chain of filters that is run document by document, in every order."""

from __future__ import annotations

from collections import Counter
from itertools import permutations

import brute
import numpy as np
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from marigold.llm import filter_audit

LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (7, None, 1), (17, 1, None), (None, 1, 1), (99, 1, 1), (19, 0, 1)]


def fails(rows):
    """For each (id, text): the filters that it fails, by counting characters."""
    least = {}
    for d, text, *_ in rows:
        if d is not None:
            least[text or ""] = min(least.get(text or "", d), d)
    for d, text, *_ in rows:
        text = text or ""
        words = text.encode().split()
        yield "".join(
            name
            for name, failed in (
                ("A", len(words) < 200),
                ("B", 100 * len(set(words)) < 50 * len(words)),
                ("C", 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)),
                ("D", any(c in text for c in "#$%&*|")),
                ("E", d is not None and least[text] < d),
            )
            if failed
        )


def audited(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    found = Counter()
    docs = [(lang or "", d, own) for (d, _, lang, *_), own in zip(rows, fails(rows))]
    for part in {p for p, *_ in docs}:
        of_part = [(d, own) for p, d, own in docs if p == part]
        table = []
        for order in permutations("ABCDE"):
            left = of_part
            for step, name in enumerate(order, 1):
                gone = [(d, own) for d, own in left if name in own]
                left = [(d, own) for d, own in left if name not in own]
                redundant = sum(name in own for _, own in of_part) - len(gone)
                lost = sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)
                table.append((order, step, name, len(left), len(gone), redundant, sum(own == name for _, own in of_part), *lost))
        total = Counter()
        for row in table:
            total[row[2]] += row[4]
        found.update((part, "".join(order), step, *rest, total[name]) for order, step, name, *rest in table)
    return found


def run(docs, labels):
    return filter_audit.audit(filter_audit.patterns(docs, labels))


def test_hard_rows(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    more = [(30 + i, f"# Loud Words {i} " + "the same again " * 90, "fr", "f", 1) for i in range(4)] + [(40 + i, brute.LONG, None, "f", 1) for i in range(5)]
    more += [(50, "", "", "f", 1), (40, brute.LONG, "de", "f", 1), (None, brute.LONG, "en", "f", 1), (-7, "loud " * 10 + "AAAA", "fr", "f", 1)]
    docs = brute.hard(spark).select(*brute.SCHEMA.replace("long", "").replace("string", "").replace(" ", "").split(","), "n", "row", "`a.b`")
    docs = docs.unionByName(spark.createDataFrame(more, brute.SCHEMA), allowMissingColumns=True)
    found = run(docs, labels)
    assert found.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    assert Counter(map(tuple, found.collect())) == audited([*brute.HARD, *more], LABELS)


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Counter(map(tuple, run(brute.hard(spark), none).collect())) == audited(brute.HARD, [])
    assert run(brute.hard(spark).limit(0), none).count() == 0


def test_other_filters_than_five():
    tensor = np.arange(24, dtype=np.int64).reshape(1, 3, 2, 2, 2)
    found = filter_audit.contract(tensor, "XYZ")
    orders, _, _ = filter_audit.selectors("XYZ")
    at = 3 * orders.index("ZXY") + 1  # X, after Z
    n = tensor[0, 0]
    assert found["kept"][0, at] == n[0, :, 0].sum() and found["removed"][0, at] == n[1, :, 0].sum()
    assert found["redundant"][0, at] == n[1, :, 1].sum() and found["unique_fails"][0, at] == n[1, 0, 0]
    assert found["good_lost"][0, at] == tensor[0, 1, 1, :, 0].sum() and found["toxic_lost"][0, at] == tensor[0, 2, 1, :, 0].sum()


def test_long_texts_are_counted_in_segments(monkeypatch):
    monkeypatch.setattr(filter_audit, "SEGMENT", 7)
    for text in ("", " ", "one", "one two one  two three", "x" * 30 + " y " + "x" * 30, "\t a b\nc \x0b\x0c\r d a "):
        words = text.encode().split()
        assert filter_audit.count_words(text.encode()) == (len(words), len(set(words)))


def test_query_equals_sql_and_chain(spark, duck, sf_dir):
    found = queries()["op12_filter_audit"](spark, sf_dir)
    names = found.columns
    got = Counter(map(tuple, found.collect()))
    assert got == Counter(duck.execute(f"select {', '.join(names)} from ({oracle_sql()['op12_filter_audit']})").fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert got == audited(rows, labels)
