"""Best-fit packing of token sequences with certified bin counts.

Pieces are dealt into partitions of a bounded number by hash, and each partition is packed by best-fit decreasing.
Dual feasible functions give a lower bound on the bins that any packing of a partition needs; where the packing
meets it, it is certified and stays. The pieces of partitions with a gap, and of the least filled bin of each other
partition, are exchanged (dealt anew by another hash) and packed again, as long as that saves bins.

Only lengths travel: one narrow row per piece. Defined cases: a null or empty text is one piece that holds only the
end id; repeated rows are packed as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marigold.llm.text import column
from marigold.llm.tokens import default_path, encoder
from marigold.staging import stage

CAPACITY = 2048
PER_PARTITION = 50_000
ROUNDS = 3
END = (0).to_bytes(4, "little")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(df: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """The pieces of every document: at most ``capacity`` ids each, only the first may be shorter where one is cut."""
    vocabulary = vocabulary or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            out: list[tuple] = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = memoryview(encode(body.as_py()) + END)
                n = len(raw) // 4
                ends = range(n % capacity or capacity, n + 1, capacity)
                starts = [0, *ends[:-1]]
                out += [(name, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(starts, ends))]
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = df.select(column(df, doc_id).cast("long").alias("doc_id"), column(df, text).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: the longest first, each into the fullest bin that still holds it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: dict[int, list[int]] = {}
    rooms: list[int] = []  # the different rooms left, in order
    used = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            stack = open_bins[room]
            chosen = stack.pop()
            if not stack:
                del open_bins[room], rooms[at]
        else:
            room, chosen, used = capacity, used, used + 1
        bins[item], offsets[item] = chosen, capacity - room
        left = room - length
        if left:
            if left not in open_bins:
                open_bins[left] = []
                insort(rooms, left)
            open_bins[left].append(chosen)
    return bins, offsets


def bin_bound(lengths: np.ndarray, capacity: int, most: int = 20) -> int:
    """Bins that any packing needs: the best of the volume and two families of dual feasible functions.

    The first drops items below a threshold and lets those within it of a whole bin fill one; the second rounds a
    length down to a multiple of 1/k of the bin, unless (k+1) times it is whole.
    """
    size, count = np.unique(lengths, return_counts=True)
    if not len(size):
        return 0
    best = math.ceil(int(size @ count) / capacity)
    for threshold in size[size * 2 <= capacity]:
        value = np.where(size > capacity - threshold, capacity, np.where(size < threshold, 0, size))
        best = max(best, math.ceil(int(value @ count) / capacity))
    for k in range(1, most):
        whole, rest = np.divmod((k + 1) * size, capacity)
        scaled = np.where(rest == 0, k * size, whole * capacity)
        best = max(best, math.ceil(int(scaled @ count) / (k * capacity)))
    return best


def _round(rows: DataFrame, number: int, parts: int, capacity: int) -> DataFrame:
    """``row, length`` dealt into partitions and packed: with bin, offset, the partition's bins and bound, and the bin's fill."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy()
        order = np.argsort(frame["row"].to_numpy(), kind="stable")  # rows of a shuffle come in any order
        frame, lengths = frame.iloc[order], lengths[order]
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        least = int(np.argmin(fill))
        return pd.DataFrame({
            "row": frame["row"].to_numpy(), "length": lengths, "part": frame["part"].to_numpy(), "bin": bins, "offset": offsets,
            "bins": len(fill), "bound": bin_bound(lengths, capacity), "loose": (bins == least) & (fill[bins] < capacity),
        })

    dealt = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(number), "row"), F.lit(parts)).cast("int"))
    packed = dealt.groupBy("part").applyInPandas(fit, "row long, length long, part int, bin long, offset long, bins long, bound long, loose boolean")
    return stage(packed.withColumn("round", F.lit(number)), f"pack-{number}")


def _bins(packed: DataFrame) -> int:
    return packed.agg(F.countDistinct("round", "part", "bin").alias("n")).first()["n"]


def place(rows: DataFrame, capacity: int = CAPACITY, per_partition: int = PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """``row, sequence_id, offset`` for every ``row, length`` of a staged table.

    The driver learns two numbers a round: how many pieces are exchanged and how many bins they fill.
    """
    done = _round(rows, 0, max(1, math.ceil(rows.count() / per_partition)), capacity)
    for number in range(1, rounds + 1):
        pool = done.filter((F.col("bins") > F.col("bound")) | F.col("loose"))
        n, before = pool.agg(F.count("*"), F.countDistinct("round", "part", "bin")).first()
        if before < 2:
            break
        again = _round(pool.select("row", "length"), number, max(1, math.ceil(n / per_partition)), capacity)
        if _bins(again) >= before:
            break
        rest = done.filter((F.col("bins") <= F.col("bound")) & ~F.col("loose"))
        done = rest.unionByName(again)
    sequence = F.col("round").cast("long") * (1 << 56) + F.col("part").cast("long") * (1 << 32) + F.col("bin")
    return done.select("row", sequence.alias("sequence_id"), "offset")


def pack(df: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, vocabulary: str | None = None, per_partition: int = PER_PARTITION) -> DataFrame:
    """Every piece of every document with the sequence it is in and its place there, without gaps from 0."""
    cut = pieces(df, text, doc_id, capacity, vocabulary).withColumn("row", F.monotonically_increasing_id())
    rows = stage(cut, "pieces")
    placed = place(rows.select("row", "length"), capacity, per_partition)
    return rows.join(placed, "row").drop("row")
