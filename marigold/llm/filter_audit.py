"""What each filter of a chain removes, in every order the filters can have, from one table of counts per part.

A document passes or fails each filter by itself, so a chain of k filters sees no more of a part than how many of its
documents have each of the 2**k patterns of failures. These counts are a tensor with one axis per filter (0 passes, 1
fails). Every figure of the audit is a contraction of it: along each axis a vector selects who passes, who fails, or all.
One einsum over the selectors of all steps of all orders gives the whole audit of many parts.

The patterns come from one pass over the texts. A document fails the copy filter if a smaller id anywhere in the table
has the same text; of a text only a 128-bit digest, its id and its pattern are shuffled. The least id of each text is
found by aggregation and met by a join on digest *and* id, so a text that a third of all documents share is spread over
all tasks.

Defined cases: a null text is an empty one, a null part the empty string; rows without an id are copies of nothing and
nobody's original; rows that share the least id of a text all pass the copy filter; a document is good (toxic) if any
label row of its id says so; labels of no document count for nothing; an empty table gives an empty audit; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marigold.llm.text import column
from marigold.staging import stage

MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITAL_PCT = 3
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILTERS = "ABCDE"

SEGMENT = 1 << 22
BLANK = re.compile(rb"[\x20\x09-\x0D]")
PARTS_AT_ONCE = 64
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def count_words(raw: bytes) -> tuple[int, int]:
    """How many words a text has and how many different ones, a segment at a time."""
    n, met, at = 0, set(), 0
    while at < len(raw):
        cut = BLANK.search(raw, at + SEGMENT) if len(raw) - at > SEGMENT else None
        end = cut.start() if cut else len(raw)
        words = raw[at:end].split()
        n += len(words)
        met.update(words)
        at = end
    return n, len(met)


def text_failures(text: str | None) -> tuple[int, bytes]:
    """The pattern of the four filters that judge a text by itself, as bits from A (highest) down, and its digest."""
    text = text or ""
    raw = text.encode()
    words, different = count_words(raw)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    fails = (
        words < MIN_WORDS,
        100 * different < MIN_DISTINCT_PCT * words,
        100 * capitals > MAX_CAPITAL_PCT * len(text),
        len(raw.translate(None, SYMBOLS)) < len(raw),
    )
    return int("".join("01"[f] for f in fails), 2), hashlib.blake2b(raw, digest_size=16).digest()


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_failures(text.as_py()) for text in batch.column(2)]
        own = pa.array([pattern for pattern, _ in found], pa.int32()), pa.array([digest for _, digest in found], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own], names=["doc_id", "part", "pattern", "digest"])


def patterns(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``part, pattern, n, n_good, n_toxic``: how many documents of each part fail just the filters of a pattern."""
    slim = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), F.coalesce(column(docs, part).cast("string"), F.lit("")).alias("part"), column(docs, text).alias("text"))
    judged = slim.mapInArrow(_judge, "doc_id long, part string, pattern int, digest binary")
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    said = said.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flags = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    alike = judged.join(said, "doc_id", "left").groupBy("digest", "doc_id", "part", "pattern", *flags).agg(F.count(F.lit(1)).alias("n"))
    alike = stage(alike, "judged")
    least = alike.groupBy(F.col("digest").alias("its_digest")).agg(F.min("doc_id").alias("least")).filter("least is not null")
    first = (F.col("digest") == F.col("its_digest")) & (F.col("doc_id") == F.col("least"))
    copy = (F.col("doc_id").isNotNull() & F.col("least").isNull()).cast("int")
    whole = alike.join(least, first, "left").withColumn("pattern", F.col("pattern") * 2 + copy)
    return whole.groupBy("part", "pattern").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"), F.sum(F.col("n") * F.col("toxic")).alias("n_toxic")
    )


def selectors(filters: str) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
    """All orders, the filter of each of their steps, and per figure the selecting vectors: step by filter by (pass, fail)."""
    k = len(filters)
    orders = list(permutations(range(k)))
    vectors = {"pass": (1, 0), "fail": (0, 1), "all": (1, 1)}

    def rows(of) -> np.ndarray:
        return np.array([[vectors[of(order, i, f)] for f in range(k)] for order in orders for i in range(k)], dtype=np.int64)

    figures = {
        "kept": rows(lambda order, i, f: "pass" if order.index(f) <= i else "all"),
        "removed": rows(lambda order, i, f: "fail" if order[i] == f else "pass" if order.index(f) < i else "all"),
        "failing": rows(lambda order, i, f: "fail" if order[i] == f else "all"),
        "unique_fails": rows(lambda order, i, f: "fail" if order[i] == f else "pass"),
    }
    return ["".join(filters[f] for f in order) for order in orders], np.array([f for order in orders for f in order]), figures


def contract(tensors: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """The figures of every step, part by step, from tensors of shape (parts, 3 measures, 2, ..., 2)."""
    _, at, figures = selectors(filters)
    axes = ascii_lowercase[: len(filters)]
    recipe = f"yz{axes},{','.join(f'x{a}' for a in axes)}->zyx"

    def select(name: str, measures: slice) -> np.ndarray:
        return np.einsum(recipe, tensors[:, measures], *[figures[name][:, f] for f in range(len(filters))])

    removed, good, toxic = select("removed", slice(None))
    (kept,), (failing,), (unique) = select("kept", slice(1)), select("failing", slice(1)), select("unique_fails", slice(1))
    by_filter = np.stack([removed[:, at == f].sum(axis=1) for f in range(len(filters))], axis=1)
    found = (kept, removed, failing - removed, unique[0], good, toxic, by_filter[:, at])
    return dict(zip(COUNTS, found))


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the rows of ``patterns``; all figures count documents."""
    k = len(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, _, _ = selectors(filters)
        order_of = pa.array(orders, pa.string()).take(pa.array(np.repeat(np.arange(len(orders)), k)))
        step_of = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)))
        for batch in batches:
            for at in range(0, len(batch), PARTS_AT_ONCE):
                rows = batch.slice(at, PARTS_AT_ONCE)
                tensors = np.zeros((len(rows), 3, 2**k), dtype=np.int64)
                for p, cells in enumerate(rows.column(1).to_pylist()):
                    for cell in cells:
                        tensors[p, :, cell["pattern"]] += (cell["n"], cell["n_good"], cell["n_toxic"])
                found = contract(tensors.reshape(len(rows), 3, *(2,) * k), filters)
                part = rows.column(0).take(pa.array(np.repeat(np.arange(len(rows)), len(step_of))))
                order, step = (pa.concat_arrays([c] * len(rows)) for c in (order_of, step_of))
                yield pa.RecordBatch.from_arrays([part, order, step, *[pa.array(found[c].ravel()) for c in COUNTS]], names=["part", "filter_order", "step", *COUNTS])

    # At most 2**k cells a part.
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("pattern", "n", "n_good", "n_toxic")).alias("cells"))
    return cells.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
