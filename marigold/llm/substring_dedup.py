"""Removal of passages that occur earlier, by Rabin-Karp hashes of every window of a fixed number of words.

A window stays if no equal one starts earlier (in an earlier document, or earlier in its own); every word that some
other window covers is removed. Overlapping and touching windows merge into maximal intervals.

1. Sieve. Equal windows choose equal anchors: of the runs of ``ANCHOR`` words in a window, the one with the least
   hash. Anchors are about a seventh of all places. An anchor that the corpus has once shows that none of its windows
   repeats. This prunes and never decides.
2. Windows whose anchor repeats are hashed (96 bits, of two hashes) and counted: the earliest stays.

In both steps each task decides what it can by itself and sends on one row per hash, so that the passage of a third
of all documents is as many rows as there are tasks. Texts are shuffled once, by document, for both joins.

Documents are ordered by id, nulls last, then by a hash of the text. Defined cases: null and empty texts have no
words and nothing removed; texts shorter than a window lose nothing; rows with equal id and text count as one
document and are treated alike; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marigold.llm.hashing import mix, run_hashes, word_hashes
from marigold.llm.text import column
from marigold.staging import stage

WINDOW = 20
ANCHOR = 8
LAST = (1 << 63) - 1


def anchors(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``anchor`` words, and for each window the place of its anchor (the first of equals)."""
    runs = run_hashes(words, anchor)
    span = window - anchor + 1
    if len(runs) < span:
        return runs, np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(runs, span)
    return runs, views.argmin(axis=1) + np.arange(len(views))


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    return zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())


def _table(names: list[str], columns: list[np.ndarray], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + rows]) for c in columns], names=names)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sieve(window: int, anchor: int) -> Callable:
    """Per task: one row for each different anchor hash, and one, marked as repeated, for each place of those met twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for batch in batches:
            for k1, k2, raw in _documents(batch):
                runs, places = anchors(word_hashes(raw or b""), window, anchor)
                if len(places):
                    places = places[np.flatnonzero(np.diff(places, prepend=-1))]
                    kept.append((np.full(len(places), k1), np.full(len(places), k2), places.astype(np.int32), runs[places]))
        if not kept:
            return
        k1, k2, place, key = (np.concatenate(c) for c in zip(*kept))
        kept.clear()
        _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        # A marked place gets a key of its own; the hash itself goes on once.
        own = mix(key + np.arange(len(key), dtype=np.uint64) * np.uint64(2654435761) + np.uint64(k2.view(np.uint64)[0]))
        first.sort()  # rows of one document stay together, which compresses well
        for rows, keys, marks in ((first, key[first], np.zeros(len(first), bool)), (np.flatnonzero(twice), own[twice], np.ones(int(twice.sum()), bool))):
            yield from _table(["key", "known", "k1", "k2", "place"], [_signed(keys), marks, k1[rows], k2[rows], place[rows]])

    return run


def _count(window: int, anchor: int) -> Callable:
    """Per task: the earliest place of each candidate window, and merged intervals, marked as repeated, of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for batch in batches:
            for (k1, k2, raw), known in zip(_documents(batch), batch.column(3)):
                words = word_hashes(raw)
                _, places = anchors(words, window, anchor)
                starts = np.flatnonzero(np.isin(places, known.values.to_numpy()))
                kept.append((np.full(len(starts), k1), np.full(len(starts), k2), starts.astype(np.int32), run_hashes(words, window)[starts], run_hashes(mix(words), window)[starts]))
        if not kept:
            return
        k1, k2, start, key, check = (np.concatenate(c) for c in zip(*kept))
        kept.clear()
        order = np.lexsort((start, k2, k1, check, key))
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
        head = np.empty(len(key), np.int64)  # for each window the earliest equal one here
        head[order] = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        later = np.flatnonzero((k1 != k1[head]) | (k2 != k2[head]) | (start != start[head]))
        first = np.sort(order[fresh])  # rows of one document stay together, which compresses well
        names = ["key", "check", "known", "k1", "k2", "start", "end"]
        yield from _table(names, [_signed(key[first]), _short(check[first]), np.zeros(len(first), bool), k1[first], k2[first], start[first], start[first] + np.int32(window)])
        k1, k2, start = k1[later], k2[later], start[later]
        if len(k1):
            gap = np.ones(len(k1), bool)
            gap[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (start[1:] > start[:-1] + window) | (start[1:] < start[:-1])
            begin = np.flatnonzero(gap)
            last = np.append(begin[1:], len(k1)) - 1
            own = mix(k2[begin].view(np.uint64) + start[begin].astype(np.uint64) * np.uint64(2654435761))
            yield from _table(names, [_signed(own), _short(mix(own)), np.ones(len(begin), bool), k1[begin], k2[begin], start[begin], start[last] + np.int32(window)])

    return run


def _short(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _removed(spans: pa.Scalar, n: int) -> np.ndarray:
    """A mask of the words in any of the ``[start, end)`` spans, each packed into one integer."""
    change = np.zeros(n + 1, np.int32)
    if spans.is_valid:
        packed = spans.values.to_numpy()
        np.add.at(change, packed >> 32, 1)
        np.add.at(change, packed & 0xFFFFFFFF, -1)
    return np.cumsum(change[:n]) > 0


def deduplicate(df: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text``: what is left of each text, words joined by one space."""
    body = column(df, text)
    docs = df.select(F.coalesce(column(df, doc_id).cast("long"), F.lit(LAST)).alias("k1"), F.xxhash64(body).alias("k2"), body.alias("text"), column(df, doc_id).cast("long").alias("doc_id"))

    places = docs.select("k1", "k2", "text").mapInArrow(_sieve(window, anchor), "key long, known boolean, k1 long, k2 long, place int")
    met = F.count("*").over(Window.partitionBy("key"))
    repeated = places.withColumn("met", met).filter("known or met > 1")
    known = stage(repeated.groupBy("k1", "k2").agg(F.collect_list("place").alias("places")), "anchors")

    schema = "key long, check int, known boolean, k1 long, k2 long, start int, end int"
    joined = docs.join(known, ["k1", "k2"])
    # The same columns as in the last join, so that Spark shuffles the texts once for both.
    windows = joined.select("k1", "k2", "text", "places", "doc_id").mapInArrow(_count(window, anchor), schema)
    order = Window.partitionBy("key", "check").orderBy("k1", "k2", "start")
    later = windows.withColumn("place", F.rank().over(order)).filter("known or place > 1")
    spans = later.groupBy("k1", "k2").agg(F.collect_list(F.shiftleft(F.col("start").cast("long"), 32) + F.col("end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts, digests = [], [], [], []
            for raw, found in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
                words = (raw or b"").split()
                gone = _removed(found, len(words))
                n = int(gone.sum())
                left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if n else words)
                counts.append(len(words))
                removed.append(n)
                texts.append(left)
                digests.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    whole = docs.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return whole.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
