"""Near-duplicate documents by b-bit MinHash.

A document's set is that of its different word shingles. ``MINIMA`` minima are taken over random multipliers; bands
of as many full minima as the threshold allows are buckets. Of every minimum only the low ``BITS`` bits are kept, packed into a signature:
where a share ``m`` of them agree, similarity is estimated as ``(m - c) / (1 - c)``, ``c = 2**-BITS`` being the
agreement by chance. Pairs whose estimate is five standard deviations below the threshold are dismissed, all others are
confirmed on the full sets. A pair at the threshold misses all buckets with a chance of ``MISS`` at most, more
similar ones less.

Documents with equal sets are one node. All nodes that share a bucket with the same least node form a group; every
pair of one bucket is in one group. Groups are dealt into blocks of a bounded number of nodes and compared block by
block, best estimates first, passing over pairs that are connected by then. What leaves a task is a spanning forest
of confirmed links.

Defined cases: documents without words (null, empty) have an empty set and link with nothing; shorter ones have one
shingle, their whole sequence; rows with one id and text are alike; a null id is larger than any other; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marigold.llm.components import components
from marigold.llm.hashing import mix, run_hashes, word_hashes
from marigold.llm.text import column, fresh
from marigold.staging import stage

SHINGLE = 5
PERCENT = 80
MINIMA = 256
MISS = 1e-5
BITS = 4
BLOCK = 512
_MULTIPLIERS = np.random.default_rng(20100426).integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(raw: bytes | None, length: int) -> np.ndarray:
    """Sorted hashes of the different shingles of a text in lower case."""
    words = word_hashes(raw or b"", lower=True)
    return np.unique(run_hashes(words, min(length, len(words)))) if len(words) else words


def minima(members: np.ndarray) -> np.ndarray:
    out = np.full(len(_MULTIPLIERS), 2**64 - 1, dtype=np.uint64)
    for i in range(0, len(members), 512):
        np.minimum(out, (_MULTIPLIERS[:, None] * members[None, i : i + 512]).min(axis=1), out=out)
    return out


def rows_in_band(percent: int) -> int:
    """As many minima in a band as let a pair at the threshold miss all bands with a chance of ``MISS`` at most."""
    t = percent / 100
    fits = [r for r in range(1, 17) if (1 - t**r) ** (MINIMA // r) <= MISS]
    return max(fits, default=1)


def band_keys(least: np.ndarray, rows: int) -> np.ndarray:
    bands = MINIMA // rows
    keys = np.arange(bands, dtype=np.uint64)
    for row in least[: bands * rows].reshape(bands, rows).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def signature(least: np.ndarray) -> bytes:
    """The low bits of the minima, packed into 64-bit words."""
    low = (least & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=1).tobytes()


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of each signature of ``a`` with each of ``b``, by bit counts."""
    lowest = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    differ = np.zeros((len(a), len(b)), dtype=np.uint16)
    for left, right in zip(a.T, b.T):
        x = left[:, None] ^ right[None, :]
        folded = x.copy()
        for shift in range(1, BITS):
            folded |= x >> np.uint64(shift)
        differ += np.bitwise_count(folded & lowest)
    chance = 2.0**-BITS
    return (1 - differ / MINIMA - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    """Five standard deviations below the threshold."""
    chance, t = 2.0**-BITS, percent / 100
    agree = chance + (1 - chance) * t
    return t - 5 * math.sqrt(agree * (1 - agree) / MINIMA) / (1 - chance)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """``100 * |a & b| >= percent * |a | b|`` for sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    merged = np.concatenate([a, b])
    merged.sort(kind="stable")
    both = int((merged[1:] == merged[:-1]).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(nodes: list[int], blocks: list[int], signatures: list[bytes], sets: list[bytes], i: int, j: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between block ``i`` and block ``j`` (or within one) of a group."""
    left = [k for k, b in enumerate(blocks) if b == i]
    right = left if i == j else [k for k, b in enumerate(blocks) if b == j]
    if not left or not right:
        return []
    signs = np.frombuffer(b"".join(signatures), dtype=np.uint64).reshape(len(nodes), -1)
    guess = estimates(signs[left], signs[right])
    sizes = np.array([len(s) for s in sets])
    small, large = np.minimum(sizes[left][:, None], sizes[right][None, :]), np.maximum(sizes[left][:, None], sizes[right][None, :])
    maybe = (guess >= least_estimate(percent)) & (100 * small >= percent * large)
    if i == j:
        maybe = np.triu(maybe, 1)
    rows, columns = np.nonzero(maybe)
    order = np.argsort(-guess[rows, columns], kind="stable")
    members = [np.frombuffer(s, dtype=np.uint64) for s in sets]
    parent = list(range(len(nodes)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    found = []
    for r, c in zip(rows[order].tolist(), columns[order].tolist()):
        a, b = left[r], right[c]
        x, y = root(a), root(b)
        if x != y and nodes[a] != nodes[b] and similar(members[a], members[b], percent):
            parent[y] = x
            found.append((nodes[a], nodes[b]))
    return found


def _documents(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    body = column(df, text)
    return df.select(column(df, doc_id).alias("doc_id"), F.xxhash64(body).alias("k2"), body.alias("text"))


def _describe(shingle: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands, signs = [], [], [], []
            for raw in batch.column(3).cast(pa.binary()).to_pylist():
                members = shingles(raw, shingle)
                sizes.append(len(members))
                if len(members):
                    least = minima(members)
                    digests.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(least, rows).view(np.int64))
                    signs.append(signature(least))
                else:
                    digests.append(None)
                    bands.append(None)
                    signs.append(None)
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "k2", "n_shingles", "digest", "bands", "sign"])

    return run


def _links(docs: DataFrame, nodes: DataFrame, shingle: int, percent: int, block: int) -> DataFrame:
    """``a, b``: confirmed links between nodes, enough of them to connect whatever links connect."""
    spread = nodes.select("node", F.explode("bands").alias("key"))
    buckets = spread.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).filter("n > 1")
    groups = stage(spread.join(buckets, "key").select("pivot", "node").distinct(), "groups")

    wanted = groups.select("node").distinct().join(nodes.select("node", "doc_id", "k2", "sign"), "node")
    named = wanted.withColumnRenamed("doc_id", "name").withColumnRenamed("k2", "hash")
    texts = docs.join(named, (F.col("k2") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("name"))).select("node", "sign", "text")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(raw, shingle).tobytes() for raw in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.large_binary()).cast(pa.binary())], names=["node", "sign", "members"])

    sets = stage(texts.mapInArrow(full, "node long, sign binary, members binary"), "sets")

    sizes = groups.groupBy("pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = groups.join(sizes, "pivot").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("task", F.explode(_tasks(F.col("block"), F.col("blocks")))).select("pivot", "task.i", "task.j", "block", "node")
    keys = ["pivot", "i", "j"]
    rows = dealt.join(sets, "node").repartition(*keys).sortWithinPartitions(*keys, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task: tuple | None = None
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            found = confirmed(*map(list, zip(*held)), task[1], task[2], percent) if len(held) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, row in zip(zip(*columns[:3]), zip(columns[4], columns[3], columns[5], columns[6])):
                if key != task:
                    if held:
                        yield close()
                    task, held = key, []
                held.append(row)
        if held:
            yield close()

    return rows.select(*keys, "block", "node", "sign", "members").mapInArrow(compare, "a long, b long")


def _tasks(block: Column, blocks: Column) -> Column:
    """Pairs ``i <= j`` of blocks that a block is in."""
    lower = F.transform(F.sequence(F.lit(0), block), lambda i: F.struct(i.alias("i"), block.alias("j")))
    higher = F.transform(F.sequence(block, blocks - 1), lambda j: F.struct(block.alias("i"), j.alias("j")))
    return F.array_distinct(F.concat(lower, higher))


def group(df: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, k2, n_shingles, component_id, component_k2, kept`` for every row; ``k2`` is ``xxhash64`` of the text.

    ``kept`` marks the rows with the least id of their group; of rows with equal ids, those with the least ``k2``.
    ``component_id, component_k2`` are theirs.
    """
    docs = _documents(df, text, doc_id)
    kind = dict(docs.dtypes)["doc_id"]
    given = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "k2", "text")
    schema = f"row long, doc_id {kind}, k2 long, n_shingles long, digest binary, bands array<long>, sign binary"
    rows = stage(given.mapInArrow(_describe(shingle, rows_in_band(percent)), schema), "signatures")
    classes = rows.filter("digest is not null").groupBy("digest").agg(F.min("row").alias("node"))
    classes = stage(classes, "classes")
    nodes = rows.drop("digest").join(classes.select(F.col("node").alias("row")), "row").withColumnRenamed("row", "node")
    labels = components(_links(docs, nodes, shingle, percent, block))

    members = rows.select("row", "doc_id", "k2", "n_shingles", "digest").join(classes, "digest", "left").join(labels, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node", "row"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k2")
    groups = stage(members.groupBy("component").agg(F.min(order).alias("least")), "least")  # a hot group's join can be split
    chosen = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("k2") == F.col("least.k2"))
    least = F.col("least.doc_id").alias("component_id"), F.col("least.k2").alias("component_k2")
    return members.join(groups, "component").select("doc_id", "k2", "n_shingles", *least, chosen.alias("kept"))


def alike(pairs: DataFrame, keep: tuple[str, ...], shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The columns in ``keep`` of the rows of ``pairs`` whose ``text`` and ``other`` are as similar as ``percent``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for a, b in zip(batch.column(0), batch.column(1)):
                x, y = (shingles(t.as_buffer().to_pybytes() if t.is_valid else None, shingle) for t in (a, b))
                near.append(len(x) > 0 and len(y) > 0 and similar(x, y, percent))
            yield batch.select(list(range(2, batch.num_columns))).filter(pa.array(near, pa.bool_()))

    rows = pairs.select("text", "other", *keep)
    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in rows.dtypes[2:]))


def deduplicate(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each group of near-duplicates, with the columns it had; rows without words all stay."""
    found = group(df, text, doc_id, **options)
    chosen = found.filter("kept").groupBy("doc_id", "k2").agg(F.max("n_shingles").alias("n"))
    (whole,) = fresh(df, "whole")
    rows = df.select(F.struct(*[column(df, c) for c in df.columns]).alias(whole), column(df, doc_id).alias("name"), F.xxhash64(column(df, text)).alias("hash"))
    rows = rows.join(chosen, (F.col("hash") == F.col("k2")) & F.col("name").eqNullSafe(F.col("doc_id")))
    again = F.row_number().over(Window.partitionBy("hash", "name").orderBy(F.lit(1)))
    rows = rows.withColumn("again", again).filter("again = 1 or n = 0")
    return rows.select(*[F.col(whole).getField(c).alias(c) for c in df.columns])
