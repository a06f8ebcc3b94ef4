"""The manifest against a tree that is hashed node by node, in plain lists."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from marigold.llm import merkle

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def rounds(row):
    """All rows of nodes up to the one that is left."""
    rows = [row]
    while len(rows[-1]) > 1:
        rows.append([sha("".join(rows[-1][i : i + 8])) for i in range(0, len(rows[-1]), 8)])
    return rows


def way(rows, i):
    """What stands before and after a node and its ancestors in their runs."""
    for row in rows[:-1]:
        start = i // 8 * 8
        yield "".join(row[start:i]), "".join(row[i + 1 : start + 8])
        i //= 8


def expected(docs):
    parts = {}
    for doc in docs:
        parts.setdefault(doc[2], []).append(doc)
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for part in order:
        ranked = sorted(parts[part], key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
        trees[part] = ranked, rounds([leaf(*d) for d in ranked])
    whole = rounds([trees[p][1][-1][0] for p in order])
    root, found = whole[-1][0], Counter()
    for at, part in enumerate(order):
        ranked, rows = trees[part]
        for i, doc in enumerate(ranked):
            path = [*way(rows, i), *way(whole, at)]
            hit = doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 3 == 0
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in doc[1]) if hit and doc[1] is not None else doc[1]
            folded = leaf(doc[0], text, *doc[2:])
            for before, after in path:
                folded = sha(before + folded + after)
            found[(doc[0], rows[0][i], rows[-1][0], root, sha("".join(b + a for b, a in path)), folded, folded == root)] += 1
    return found


def checked(docs, height=merkle.HEIGHT):
    return merkle.check(merkle.build(merkle.leaves(docs, claim=merkle.tampered(docs)), height))


def got(df):
    assert df.columns == NAMES
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5, 6])
def test_addresses_are_a_layout_by_halves(levels):
    places = [merkle.row_addresses(levels, d) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.size(levels)))
    for depth in range(levels):  # every subtree below the upper half lies in one stretch
        if levels > 1 and depth == levels // 2:
            for node in range(8**depth):
                own = np.concatenate([merkle.address(levels, d, np.arange(node * 8 ** (d - depth), (node + 1) * 8 ** (d - depth))) for d in range(depth, levels)])
                assert own.max() - own.min() + 1 == len(own) == merkle.size(levels - depth)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 513, 4095, 4096])
def test_a_block_is_a_tree(n):
    row = [sha(str(i)) for i in range(n)]
    payload, root = merkle.build_block(row, merkle.levels_of(n))
    own, found = merkle.siblings(payload, n)
    rows = rounds(row)
    assert own == row and root == rows[-1][0] and len(payload) == 32 * merkle.size(len(rows))
    for i in {0, n // 2, n - 1}:
        assert merkle.path_of(found, i) == list(way(rows, i))
        assert merkle.fold(row[i], merkle.path_of(found, i)) == root


def test_hard_rows(spark):
    more = [(20 + i, f"Text {i}", "xx", "s", i) for i in range(70)] + [(200 + i, "", f"lang{i}", None, None) for i in range(12)] + [(5, "A", "", "s", 1)]
    docs = brute.hard(spark).unionByName(spark.createDataFrame(more, brute.SCHEMA), allowMissingColumns=True)
    assert got(checked(docs)) == expected([*brute.HARD, *more])
    assert checked(docs.limit(0)).count() == 0


@pytest.mark.parametrize("height", [1, 2])
def test_blocks_over_blocks(spark, height):
    """Small blocks: parts of one to 1,300 leaves end on levels of blocks of their own, and so does the tree over 90 parts."""
    rows = [(i, f"T{i}", "big", "s", i) for i in range(1300)] + [(5000 + i, "Some", f"p{i % 90:02}", None, i) for i in range(700)]
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(5)
    assert got(checked(docs, height)) == expected(rows)


def test_a_part_of_more_than_one_block(spark):
    rows = [(i, f"Word {i}", "en" if i % 50 else None, "s", i) for i in range(9_000)]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    assert got(checked(docs)) == expected(rows)


def test_any_change_is_found(spark):
    rows = [(i, f"Word {i}", "en", "s", i) for i in range(40)]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    claims = {1: ("source", "t"), 2: ("n_chars", 7), 3: ("text", "word 3")}
    for doc_id, (name, value) in claims.items():
        changed = [F.when(F.col("doc_id") == doc_id, F.lit(value)).otherwise(F.col(c)) if c == name else F.col(c) for c in merkle.COLUMNS]
        found = merkle.check(merkle.build(merkle.leaves(docs, claim=merkle.leaf_hash(*changed))))
        assert {r["doc_id"] for r in found.filter("not verified").collect()} == {doc_id}


def test_query_equals_sql_and_lists(spark, duck, sf_dir):
    found = got(queries()["op11_merkle_manifest"](spark, sf_dir))
    assert found == Counter(duck.execute(f"select {', '.join(NAMES)} from ({oracle_sql()['op11_merkle_manifest']})").fetchall())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert found == expected([tuple(d) for d in docs])


def test_equal_rows_are_dealt_over_tasks(spark):
    rows = [(1, "the same", "en", "s", 8)] * 3000 + [(i, "own", "en", "s", 3) for i in range(2, 900)]
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(6)
    assert got(checked(docs, 2)) == expected(rows)
    numbered = merkle.leaves(docs).withColumn("tie", F.monotonically_increasing_id())
    placed = merkle._place(numbered, "doc_id", "digest", "tie")
    assert sorted(r["rank"] for r in placed.select("rank").collect()) == list(range(len(rows)))
