"""Copies over many sources leave one document, though line dedup takes their lines for boilerplate."""

from __future__ import annotations

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FURNITURE = "this footer stands on every site there is"


def prose(name, lines=12):
    return [f"{name}{i} begins a line of {name}{i}a prose with {name}{i}b words {name}{i}c of its {name}{i}d own" for i in range(lines)]


def table():
    exact = "\n".join(["Read more", *prose("exact"), "Sign in", FURNITURE])
    near = [[*prose("near"), "Home", "News today"] for _ in range(6)]
    for i, lines in enumerate(near):
        lines[i] = lines[i].replace("words", f"changed{i}")
    rows = [(i, exact, f"s{i}") for i in range(6)]
    rows += [(10 + i, "\n".join(lines), f"s{i}") for i, lines in enumerate(near)]
    rows += [(20 + i, "\n".join([*prose(f"alone{i}x", 2), FURNITURE]), f"s{i}") for i in range(6)]
    # Mostly what many sites share, but no copy of anything: its own words stay.
    rows += [(30, "\n".join([FURNITURE, *prose("exact", 1), "a few words of my very own here"]), "s1")]
    rows += [(None, exact, "s7"), (5, exact + "\n", "s8")]
    return [(d, t, "en", s, len(t)) for d, t, s in rows]


def test_copies_over_many_sources_leave_one_document(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(table(), SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, apply in corpus_pipeline.STAGES[:3]:
        docs = apply(spark, docs, str(tmp_path)).cache()
    texts = {d: t for d, t, *_ in reversed(table())}
    left = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    own = [(20 + i, "\n".join(prose(f"alone{i}x", 2))) for i in range(6)]
    assert left == [(0, texts[0]), (10, texts[10]), *own, (30, "a few words of my very own here")]
    ends = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert ends <= {d for d, _ in left}
