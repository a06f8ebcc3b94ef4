"""Each query over a whole table, against SQL where there is some and against brute force elsewhere."""

from __future__ import annotations

from collections import Counter

import brute
import numpy as np
import pytest

from marigold.llm.oracles import ORACLES
from marigold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def documents(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())


def result(spark, name, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF)
    theirs = duck.execute(ORACLES[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in ours.collect()) == Counter(theirs.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))
    assert set(ORACLES) <= set(QUERIES)


def test_minhash(spark):
    docs = documents(spark)
    found = brute.near_duplicates([t for _, t in docs], 3, 85)
    expected = {d: (n, docs[first][0], docs[first][0] == d) for (d, _), (n, first) in zip(docs, found)}
    assert result(spark, "op3_minhash_dedup", "n_shingles", "component_id", "kept") == expected


def test_token_files(spark):
    expected, start = {}, 0
    for d, text in documents(spark):
        values = brute.ids(text)
        expected[d] = (start, len(values), brute.crc(values))
        start += len(values)
    assert result(spark, "op4_token_files", "start", "n_tokens", "ids_crc32") == expected


def test_token_counts(spark):
    from marigold.llm.token_counts import Unigram, read_vocabulary
    from marigold.llm.tokens import CHUNK, default_path

    scores = read_vocabulary(default_path())

    def pieces(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            best.append(max((best[j][0] + scores[word[j:i]], best[j][1] - 1) for j in range(max(0, i - 128), i) if word[j:i] in scores))
        return -best[-1][1]

    docs = documents(spark)[:25]
    got = result(spark, "op5_token_counts", "n_pretokens", "n_distinct", "n_tokens")
    memo = {}
    for d, text in docs:
        chunks = CHUNK.findall(text)
        assert got[d] == (len(chunks), len(set(chunks)), sum(memo.setdefault(c, pieces(c.encode())) for c in chunks))
    model = Unigram(scores)
    model.counts([b" abcdef", b" abcxyz"])
    assert model.nodes == 10  # " abc" once


def test_mixing_meets_targets(spark):
    rows = QUERIES["op6_mix_sources"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for r in rows:
        assert r["target"] <= 2 * r["source_size"]
        assert abs(taken[r["source"]] - r["target"]) <= 0.05 * r["target"] + largest[r["source"]] / 2
    total = sum(r["size"] for r in rows)
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * total)


def test_packing(spark):
    from marigold.llm.packing import bin_bound

    rows = QUERIES["op7_pack"](spark, SF).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, text in documents(spark):
        values, at = brute.ids(text), 0
        for i, piece in enumerate(sorted(by_doc.pop(d), key=lambda r: r["piece"])):
            assert (piece["piece"], piece["start"]) == (i, at)
            assert piece["length"] == 2048 or i == 0
            assert piece["ids_crc32"] == brute.crc(values[at : at + piece["length"]])
            at += piece["length"]
        assert at == len(values)
    assert not by_doc
    for places in by_sequence.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 2048
    bound = bin_bound(np.array([r["length"] for r in rows]), 2048)
    assert bound <= len(by_sequence) <= bound + 1


def test_substring_dedup(spark):
    docs = documents(spark)
    expected = {d: row for (d, _), row in zip(docs, brute.earlier_passages([t for _, t in docs], 20))}
    assert result(spark, "op8_substring_dedup", "n_words", "n_removed", "kept_sha256") == expected


def test_classifier_on_labels_it_has_not_seen(spark):
    from marigold.llm import quality_model

    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    scored = quality_model.score(docs, labels.filter("doc_id % 3 <> 0"))
    assert scored.count() == docs.count()
    rows = scored.join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.93
    assert np.mean(bad) < 0.05
    assert quality_model.score(docs, labels.limit(0)).filter("kept").count() == docs.count()


def test_entry_point_without_the_subpackage():
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'overall_kpis' in e.queries(); assert 'pipeline' not in e.queries()"
    code = code.replace("sys.modules['corpus_pipeline'] = None", "import importlib.abc\nclass Gone(importlib.abc.MetaPathFinder):\n    def find_spec(self, name, *_):\n        if name in ('corpus_pipeline', 'marigold.llm'): raise ModuleNotFoundError(name=name)\nsys.meta_path.insert(0, Gone())\n").replace("; import __spark", "\nimport __spark")
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], check=True)
