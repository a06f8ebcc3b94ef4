"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, operator by operator."""

from __future__ import annotations

from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marigold.llm import (
    embedding_dedup, line_dedup, minhash, mixing, packing, quality_model, quality_rules, substring_dedup, token_counts, token_files,
)
from marigold.staging import scratch_path


def rows(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def token_table(df):
    path = scratch_path(df.sparkSession, "test")
    token_files.write(df, path)
    return token_files.read(df.sparkSession, path)


LABELS = "doc_id long, quality int, toxic int"
OPERATORS = {
    "classifier": lambda df: quality_model.score(df, df.sparkSession.createDataFrame([(1, 1, 0), (19, 0, 0), (None, 1, 0), (2, None, 1)], LABELS)),
    "minhash": minhash.group,
    "minhash rows": minhash.deduplicate,
    "token files": token_table,
    "token counts": token_counts.count,
    "mixing": mixing.allocate,
    "mix": mixing.mix,
    "packing": packing.pack,
    "substrings": substring_dedup.deduplicate,
    "lines": line_dedup.clean,
    "rules": quality_rules.measure,
    "cleaned": quality_rules.clean,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](brute.hard(spark).limit(0)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(spark, name):
    plain, clashing = OPERATORS[name](brute.hard(spark, clashes=False)), OPERATORS[name](brute.hard(spark))
    common = [c for c in plain.columns if c not in brute.CLASHES and c not in ("sequence_id", "offset")]
    assert rows(plain.select(*[f"`{c}`" for c in common]), *common) == rows(clashing.select(*[f"`{c}`" for c in common]), *common)
    if name in ("minhash rows", "mix", "lines", "cleaned"):
        assert set(brute.CLASHES) <= set(clashing.columns)


def test_rules(spark):
    got = rows(quality_rules.measure(brute.hard(spark)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == Counter((d, *brute.quality(t)) for d, t, *_ in brute.HARD)


def test_rules_clean_line_by_line(spark):
    prose = "Plain words make up this sentence. " * 12
    text = f"{''.join(f'{i} {w} ' for i, w in enumerate(prose.split()))}.\nHome | News | Shop | About\nAll rights reserved.\nBUY NOW AND SAVE!\nno mark here"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality_rules.clean(df).first()["text"] == text.split("\n")[0]
    lost = spark.createDataFrame([(1, text + "\nHome | News | Shop | About" * 40)], "doc_id long, text string")
    assert quality_rules.clean(lost).count() == 0


def test_token_files_and_packing(spark):
    docs = [(d, brute.ids(t)) for d, t, *_ in brute.HARD]
    got = token_table(brute.hard(spark))
    assert rows(got, "doc_id", "n_tokens", "ids_crc32") == Counter((d, len(i), brute.crc(i)) for d, i in docs)
    places = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in got.collect())
    at, last = 0, None
    for start, n, doc in places:
        assert start == at and (last is None or doc is None or doc >= last)
        at, last = at + n, doc if doc is not None else last
    pieces = packing.pack(brute.hard(spark), per_partition=10).collect()
    expected = Counter()
    for d, values in docs:
        first = len(values) % 2048 or 2048
        cuts = [0, *range(first, len(values), 2048), len(values)]
        expected.update((d, i, a, b - a, brute.crc(values[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces) == expected
    bins = {}
    for r in pieces:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 2048


def test_minhash(spark):
    texts = [t for _, t, *_ in brute.HARD]
    found = brute.near_duplicates(texts, 3, 85)
    names = [d for d, *_ in brute.HARD]
    least = {}
    for d, (_, c) in zip(names, found):
        least.setdefault(c, []).append(d)
    first = {c: min((d for d in ds if d is not None), default=None) for c, ds in least.items()}
    got = rows(minhash.group(brute.hard(spark), shingle=3, percent=85), "doc_id", "n_shingles", "component_id")
    assert got == Counter((d, n, first[c]) for d, (n, c) in zip(names, found))


def test_minhash_keeps_one_of_each_group(spark):
    left = minhash.deduplicate(brute.hard(spark)).collect()
    ids = [r["doc_id"] for r in left]
    assert ids.count(-18) == 1 and not {1, 2, 3} & set(ids)
    assert {4, 5, 6} <= set(ids) and ids.count(7) == 1


def test_minhash_in_many_blocks(spark):
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(base[:i] + [f"new{i}"] + base[i + 1 :]) for i in range(40)] + [" ".join(base)] * 9 + [f"alone {i} " + "x y z " * i for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.group(df, shingle=3, percent=85, block=7).collect()}
    assert got == dict(enumerate(brute.near_duplicates(texts, 3, 85)))


def test_substrings(spark):
    last = 1 << 62
    alike = {}
    for d, t, *_ in brute.HARD:
        alike.setdefault((d, t), []).append(d)
    order = sorted(alike, key=lambda k: last if k[0] is None else k[0])
    texts = [t for _, t in order]
    found = dict(zip(order, brute.earlier_passages(texts, 20)))
    got = rows(substring_dedup.deduplicate(brute.hard(spark)), "doc_id", "n_words", "n_removed")
    expected = Counter((d, *found[d, t][:2]) for d, t, *_ in brute.HARD if d is not None)
    assert Counter({k: n for k, n in got.items() if k[0] is not None}) == expected
    assert sum(n for k, n in got.items() if k[0] is None) == 2


def test_substrings_within_one_text(spark):
    text = " ".join(["p q r s t u v w x y z"] * 9 + ["end"])
    got = substring_dedup.deduplicate(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (got["n_words"], got["n_removed"], got["kept_sha256"]) == brute.earlier_passages([text], 20)[0]
    assert got["kept_text"] == " ".join(w for w in got["kept_text"].split())


def test_lines(spark):
    got = {(r["doc_id"], r["text"]): (r["n_lines"], r["n_removed"]) for r in line_dedup.clean(brute.hard(spark, clashes=False)).collect() if r["doc_id"] is not None}
    shared = "a line that many sites share"
    assert got[13, brute.HARD[14][1]] == (2, 0)
    assert got[14, ""] == (1, 1)
    assert got[15, "\nlast words of this text"] == (3, 1)
    assert got[16, ""] == (4, 3)
    assert (4, None) in got and got[5, ""] == (0, 0)
    assert not any(shared in (t or "") for d, t in got if d > 13)
    left = line_dedup.clean(brute.hard(spark), drop_emptied=True).filter("doc_id is not null")
    ids = {r["doc_id"] for r in left.select("doc_id").collect()}
    assert not {14, 16} & ids and {4, 5, 6, 13, 15} <= ids


def test_lines_near_the_threshold_are_counted_exactly(spark):
    texts = [(i, f"line number {n} of many", f"site{i % n}") for n in range(3, 12) for i in range(100 * n, 100 * n + 3 * n)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string")
    gone = rows(line_dedup.clean(df).filter("n_removed = 1").select((F.col("doc_id") / 100).cast("int").alias("n")), "n")
    assert gone == Counter({(n,): 3 * n - 1 for n in range(5, 12)})


def test_mixing(spark):
    got = mixing.allocate(brute.hard(spark), keep=("doc_id", "source"))
    table = got.collect()
    assert got.count() == len(brute.HARD)
    sizes, taken, target = Counter(), Counter(), {}
    for r in table:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    assert all(r["source_size"] == sizes[r["source"]] for r in table)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert rows(got, *got.columns) == rows(mixing.allocate(brute.hard(spark).repartition(5), keep=("doc_id", "source")), *got.columns)
    assert mixing.mix(brute.hard(spark)).count() == sum(r["copies"] for r in table)


def test_mixing_follows_inclusion_odds(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', 1 + int(id % 40)) as text", "concat('s', id % 3) as source")
    table = mixing.allocate(df, keep=("doc_id", "source"), weights=(1, 4, 9)).collect()
    for source in ("s0", "s1", "s2"):
        own = [r for r in table if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        base = min(r["copies"] for r in own)
        sampled = [r["size"] for r in own if r["copies"] > base]
        if sampled:
            assert np.mean(sampled) > 1.15 * np.mean([r["size"] for r in own])


def test_classifier_handles_hard_rows(spark):
    scored = OPERATORS["classifier"](brute.hard(spark))
    assert scored.count() == len(brute.HARD)
    assert scored.filter("score is null or isnan(score) or kept is null").count() == 0


def test_sparse_sites_stay_near_the_global_rate(spark):
    docs = [(i, "plain words of one text.", "en", f"s{i % 2}" if i < 400 else "few", 1) for i in range(402)]
    labels = [(i, int(i % 2 == 0), 0) for i in range(402)]
    scored = quality_model.score(spark.createDataFrame(docs, brute.SCHEMA), spark.createDataFrame(labels, LABELS), keep=("source",))
    rate = {r["source"]: r["site_rate"] for r in scored.collect()}
    assert rate["s0"] > 0.95 and rate["s1"] < 0.05 and abs(rate["few"] - 0.5) < 0.1


def test_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(420, 6))
    x[200:300] = x[:100] + rng.normal(size=(100, 6)) * 0.2
    x[300:360] = x[5]
    extra = [None, [], [float("nan")] * 6, [1.0, None] * 3, [0.0] * 6, [float("inf")] * 6, [1.0, 2.0], [2.0, 4.0], [1e300, 2e300], [-1e-300, -2e-300]]
    values = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(1000 + i, v) for i, v in enumerate(extra)]
    df = spark.createDataFrame(values, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("row", "node", "raw", "cell", "n", "copies")})
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.deduplicate(df, block=60).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    found = brute.classes(range(len(x)), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    expected = {i: (int(near[i].sum()), found[i], found[i] == i) for i in range(len(x))}
    expected |= {1000 + i: (0, 1000 + i, True) for i in (0, 1, 2, 3, 4, 5, 9)}
    expected |= {1006: (2, 1006, True), 1007: (2, 1006, False), 1008: (2, 1006, False)}
    assert got == expected
    repeated = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.1]), (None, None)], "vec_id long, embedding array<float>")
    assert rows(embedding_dedup.deduplicate(repeated), "vec_id", "n_links", "component_id") == Counter({(1, 2, 1): 2, (None, 2, 1): 1, (None, 0, None): 1})
    assert embedding_dedup.deduplicate(repeated.limit(0)).count() == 0


def test_pipeline_on_hard_rows(spark, tmp_path):
    labels = [(d, 1, 0) for d in range(1, 20) if d != 19] + [(19, 0, 0)]
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    brute.hard(spark, clashes=False).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for _, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, str(tmp_path))
        assert docs.columns == columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, brute.hard(spark, clashes=False).limit(0), str(tmp_path)).count() == 0


def test_pipeline_against_brute_force(spark):
    """Each stage on what its predecessor kept, with the rules of the stage said again in plain Python."""
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = [apply for _, apply in corpus_pipeline.STAGES]

    docs = stages[0](spark, docs, base).cache()
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(before[d] == t for d, t in kept.items())
    known = [d for d in before if d in labels]
    right = sum((d in kept) == (labels[d] == (1, 0)) for d in known)
    assert right > 0.9 * len(known)

    sites = {r["doc_id"]: r["source"] for r in docs.collect()}
    spread, first = {}, {}
    for d in sorted(kept):
        for line in kept[d].split("\n"):
            if len(line.encode().split()) >= 3:
                spread.setdefault(line.strip(" \t\r\x0b\x0c"), set()).add(sites[d])
    expected = {}
    for d in sorted(kept):
        left = []
        for line in kept[d].split("\n"):
            key = line.strip(" \t\r\x0b\x0c")
            if len(spread.get(key, ())) >= 5 and len(line.encode().split()) >= 3:
                if key in first:
                    continue
                first[key] = d
            left.append(line)
        if "\n".join(left).split() or not kept[d].split():
            expected[d] = "\n".join(left)
    docs = stages[1](spark, docs, base).cache()
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == expected
    assert docs.filter("n_chars <> length(text)").count() == 0

    names = sorted(expected)
    groups = brute.near_duplicates([expected[d] for d in names], 5, 80)
    docs = stages[2](spark, docs, base).cache()
    assert sorted(r["doc_id"] for r in docs.collect()) == [d for i, d in enumerate(names) if groups[i][1] == i]

    planned = {r["doc_id"]: r["copies"] for r in mixing.allocate(docs).collect()}
    docs = stages[3](spark, docs, base).cache()
    assert Counter(r["doc_id"] for r in docs.collect()) == Counter({d: n for d, n in planned.items() if n})
    tokens = Counter()
    for r in docs.collect():
        tokens[r["doc_id"]] += len(brute.ids(r["text"]))
    placed = Counter()
    for r in stages[4](spark, docs, base).collect():
        placed[r["doc_id"]] += r["length"]
    assert placed == tokens
