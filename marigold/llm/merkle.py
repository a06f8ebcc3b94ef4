"""A Merkle manifest of a table: one tree per part, one tree over the parts' roots, a proof and a check for every row.

A row's leaf is the SHA-256 of its columns, each with its length before it, so that no two rows read alike. The leaves of
a part stand in ascending order of id; every run of eight nodes is hashed to one until one is left, the part's subroot.
The subroots in order of part are the leaves of the tree whose root stands for the whole table.

Storage: aligned subtrees of 8**4 leaves (``height`` says otherwise) are blocks, one row each. A block holds its digests in van Emde Boas layout: a
tree of h levels is its upper h // 2 levels, then each of the trees below them, both laid out by the same rule; so a
walk from a leaf to the root touches few stretches of memory, whatever the size of a page. ``address`` says where a node
lies, for hashing upwards as for fetching siblings. The roots of the blocks are the leaves of the next level of blocks,
and so on, until a part fits into one. Blocks of a part with a third of all rows are built by as many tasks as any others.

Proofs go the other way, from the last block down: each block gets the siblings above it by a join on its number, and
hands its own and those to the blocks of its leaves, at most seven digests a level.

Places of leaves come from one range sort of digests and ids, and from counts per part and partition. Texts are read
once and not shuffled.

Defined cases: a null part stands before all others and apart from the empty one; rows without an id stand first in their
part; rows with the same id stand in order of their digests, so equal rows get equal leaves and proofs by place; an empty
table has no root and gives no rows; columns that the leaf does not name are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marigold.llm.text import column
from marigold.staging import stage

ARITY = 8
HEIGHT = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

PATHS = "key string, block long, before array<string>, after array<string>, subroot string, root string"
CHECKS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_hash(*values: Column) -> Column:
    """SHA-256 over the values: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def size(levels: int) -> int:
    """Nodes of a complete tree."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` of a depth (0: the root) lie in the layout of a tree of so many levels."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    span = ARITY ** (depth - upper)
    return size(upper) + index // span * size(levels - upper) + address(levels - upper, depth - upper, index % span)


@lru_cache(maxsize=64)
def row_addresses(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(ARITY**depth))


def levels_of(leaves: int) -> int:
    """Levels of the tree over so many leaves, leaves and root included."""
    levels = 1
    while ARITY ** (levels - 1) < leaves:
        levels += 1
    return levels


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def build_block(leaves: list[str], levels: int) -> tuple[bytes, str]:
    """The digests of a subtree in its layout, and its root. Places right of the last node of a depth stay zero."""
    nodes = np.zeros((size(levels), 32), dtype=np.uint8)
    row = leaves
    for depth in range(levels - 1, -1, -1):
        nodes[row_addresses(levels, depth)[: len(row)]] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, 32)
        if depth:
            row = [digest("".join(row[i : i + ARITY])) for i in range(0, len(row), ARITY)]
    return nodes.tobytes(), row[0]


def siblings(payload: bytes, leaves: int) -> tuple[list[str], list[list[tuple[str, str]]]]:
    """The leaves of a block; and for each depth, leaves first, what stands before and after each node in its run."""
    levels = next(n for n in count(1) if size(n) * 32 == len(payload))
    nodes, found, own, width = payload.hex(), [], None, leaves
    for depth in range(levels - 1, -1, -1):
        row = [nodes[64 * p : 64 * p + 64] for p in row_addresses(levels, depth)[:width].tolist()]
        own = own or row
        if depth:
            found.append([("".join(row[i - i % ARITY : i]), "".join(row[i + 1 : i - i % ARITY + ARITY])) for i in range(width)])
        width = -(-width // ARITY)
    return own, found


def path_of(found: list[list[tuple[str, str]]], leaf: int) -> list[tuple[str, str]]:
    """The siblings of a leaf and of its ancestors within the block."""
    return [row[leaf // ARITY**i] for i, row in enumerate(found)]


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


def _place(rows: DataFrame, *order: str) -> DataFrame:
    """``rank`` of each row within its ``key`` in the given order (nulls first), and the key's number of rows ``n``.

    One range sort; then counts per partition, of which a key has at most as many as there are partitions.
    """
    ordered = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    ordered = stage(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("slice", F.shiftright("at", 33))
    counts = ordered.groupBy("key", "slice").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first"))
    of_key = Window.partitionBy("key")
    before = F.coalesce(F.sum("here").over(of_key.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("key", "slice", (before - F.col("first")).alias("shift"), F.sum("here").over(of_key).alias("n"))
    return ordered.join(offsets, ["key", "slice"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "slice", "shift")


def _blocks(nodes: DataFrame, height: int, *carried: str) -> DataFrame:
    """One row per block of ``nodes`` (key, rank, n, digest): its layout, its root, and the carried columns as lists."""
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}

    def build(group: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table["rank"].to_numpy(), kind="stable")))
        n = table["n"][0].as_py()
        leaves = [d.hex() for d in table["digest"].to_pylist()]
        payload, root = build_block(leaves, height + 1 if n > ARITY**height else levels_of(n))
        own = [group[0], group[1], pa.scalar(n), pa.scalar(len(leaves), pa.int32()), pa.scalar(payload), pa.scalar(bytes.fromhex(root))]
        lists = [pa.array([table[c].to_pylist()], pa.list_(table[c].type)) for c in carried]
        return pa.Table.from_arrays([*[pa.array([v.as_py()], v.type) for v in own], *lists], names=["key", "block", "n", "leaves", "payload", "root", *carried])

    schema = "key string, block long, n long, leaves int, payload binary, root binary" + "".join(f", {c} array<{kinds[c]}>" for c in carried)
    numbered = nodes.withColumn("block", F.floor(F.col("rank") / ARITY**height).cast("long"))
    return numbered.groupBy("key", "block").applyInArrow(build, schema)


def _forest(nodes: DataFrame, height: int, *carried: str) -> list[DataFrame]:
    """The blocks of all trees: those over the leaves, those over their roots, and so on to one block a tree."""
    block = ARITY**height
    levels = [stage(_blocks(nodes, height, *carried), "blocks")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > block:
        most = -(-most // block)
        roots = levels[-1].filter(F.col("n") > block)
        roots = roots.select("key", F.col("block").alias("rank"), F.ceil(F.col("n") / block).cast("long").alias("n"), F.col("root").alias("digest"))
        levels.append(stage(_blocks(roots, height), "blocks"))
    return levels


def _tops(levels: list[DataFrame], level: int, height: int) -> DataFrame:
    """The last blocks of the trees that end on a level."""
    return levels[level].filter(F.col("n") <= ARITY**height)


def _hand_down(height: int) -> Callable:
    """Per leaf of each block: its number in the tree, and the siblings on its way to the root of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                own, found = siblings(block["payload"], block["leaves"])
                paths, n, first = [path_of(found, i) for i in range(len(own))], len(own), block["block"] * ARITY**height
                columns = [
                    pa.array([block["key"]] * n),
                    pa.array(range(first, first + n), pa.int64()),
                    pa.array([[b for b, _ in p] + block["before"] for p in paths], pa.list_(pa.string())),
                    pa.array([[a for _, a in p] + block["after"] for p in paths], pa.list_(pa.string())),
                    pa.array([block["subroot"]] * n),
                    pa.array([block["root"]] * n),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "block", "before", "after", "subroot", "root"])

    return run


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per leaf: the digest of its proof, and the root that its claim and the proof lead to."""
    for batch in batches:
        for block in batch.to_pylist():
            own, found = siblings(block["payload"], block["leaves"])
            above = list(zip(block["before"], block["after"]))
            proofs, folded = [], []
            for i, (leaf, claim) in enumerate(zip(own, block["claim"])):
                path = path_of(found, i) + above
                proofs.append(digest("".join([b + a for b, a in path])))
                folded.append(fold(claim.hex() if claim else leaf, path))
            n, root = len(own), block["root"]
            columns = [
                pa.array(block["doc_id"], pa.int64()), pa.array(own), pa.array([block["subroot"]] * n), pa.array([root] * n),
                pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.drop("root", "n").join(paths, ["key", "block"])


def _paths_down(levels: list[DataFrame], height: int, tops: Callable[[int], DataFrame]) -> DataFrame:
    """The siblings above each block of the lowest level; ``tops`` gives them for the trees that end on a level."""
    paths = None
    for i in range(len(levels) - 1, -1, -1):
        paths = tops(i) if paths is None else tops(i).unionByName(paths)
        if i:
            paths = _with_paths(levels[i], paths).mapInArrow(_hand_down(height), PATHS)
    return paths


@dataclass(frozen=True)
class Manifest:
    """The blocks of all parts' trees and of the tree over them, by level; per subroot its ``part, rank, digest, level``."""

    parts: list[DataFrame]
    whole: list[DataFrame]
    subroots: DataFrame
    height: int


def build(leaves: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of ``key, doc_id, digest`` and ``claim`` (a digest to be checked, null for the row's own)."""
    # The last key deals rows that are alike in all columns, however many they are, over several partitions.
    numbered = stage(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    parts = _forest(_place(numbered, "doc_id", "digest", "tie").drop("tie"), height, "doc_id", "claim")
    ends = [_tops(parts, i, height).select(F.col("key").alias("part"), F.col("root").alias("digest"), F.lit(i).alias("level")) for i in range(len(parts))]
    subroots = _place(reduce(DataFrame.unionByName, ends).withColumn("key", F.lit("")), "part")
    subroots = stage(subroots, "subroots")
    return Manifest(parts, _forest(subroots.select("key", "rank", "n", "digest"), height), subroots, height)


def check(made: Manifest) -> DataFrame:
    """One row per leaf: leaf, subroot, root, digest of its proof, and whether its claim folds to the root."""
    none = F.array().cast("array<string>")

    def root(level: int) -> DataFrame:
        tops = _tops(made.whole, level, made.height)
        return tops.select("key", "block", none.alias("before"), none.alias("after"), F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("root"))

    ways = _with_paths(made.whole[0], _paths_down(made.whole, made.height, root)).mapInArrow(_hand_down(made.height), PATHS)
    ways = ways.select(F.col("block").alias("rank"), "before", "after", "root").join(made.subroots.drop("key", "n"), "rank")
    ways = stage(ways.select(F.col("part").alias("key"), "level", "before", "after", F.lower(F.hex("digest")).alias("subroot"), "root"), "ways")

    def subroot(level: int) -> DataFrame:
        return ways.filter(F.col("level") == level).select("key", F.lit(0).cast("long").alias("block"), "before", "after", "subroot", "root")

    return _with_paths(made.parts[0], _paths_down(made.parts, made.height, subroot)).mapInArrow(_check, CHECKS)


def leaves(df: DataFrame, columns: tuple[str, ...] = COLUMNS, part: str = "lang", doc_id: str = "doc_id", claim: Column | None = None) -> DataFrame:
    """The leaf of each row, under a key that puts null before every text, beside the digest that is claimed for it."""
    key = F.coalesce(F.concat(F.lit("="), column(df, part).cast("string")), F.lit(""))
    own = leaf_hash(*[column(df, c) for c in columns])
    return df.select(key.alias("key"), column(df, doc_id).cast("long").alias("doc_id"), own.alias("digest"), (F.lit(None).cast("binary") if claim is None else claim).alias("claim"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(df: DataFrame, every: int = 3) -> Column:
    """The leaf of a row whose text was put in lower case, where ``every`` divides the CRC-32 of its id; null elsewhere."""
    hit = F.crc32(column(df, "doc_id").cast("long").cast("string").cast("binary")) % every == 0
    values = [lower_ascii(column(df, c)) if c == "text" else column(df, c) for c in COLUMNS]
    return F.when(hit, leaf_hash(*values))
