"""Token ids of documents in files of Simple-8b words, in ascending order of document.

Container: a Parquet table that Spark writes and reads in any store. One row is one shard: ``part`` and ``seq``
give its place, ``n_docs`` and ``n_ids`` its extent, ``payload`` its bytes: the magic ``S8B1``, the numbers of
documents, ids, blocks and words (four 64-bit integers), then per document a flag (1: the id is null), the id
(64 bit) and the number of ids (64 bit), per block the first word (32 bit, and the number of words at the end), and the
words. Everything is little-endian. A shard ends with the document that fills it, so no document lies in two.

Documents are ordered by id, nulls first, and by a hash of the text where ids are equal, which also splits the rows
of one id over tasks. Defined cases: a null or empty text is the end id alone; repeated rows are written as often as
they come; an empty table gives a container without shards; other columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marigold.llm import simple8b
from marigold.llm.text import column
from marigold.llm.tokens import default_path, encoder

MAGIC = b"S8B1"
SHARD_IDS = 1 << 20
END = (0).to_bytes(4, "little")
SHARDS = "part int, seq int, n_docs long, n_ids long, payload binary"
RECORDS = "part int, seq int, place int, doc_id long, before long, n_tokens long, ids_crc32 long"


def to_bytes(doc_ids: list[int | None], encoded: list[bytes]) -> bytes:
    """A shard of documents whose ids come as little-endian unsigned 32-bit integers."""
    values = np.frombuffer(b"".join(encoded), dtype="<u4")
    words, offsets = simple8b.pack(values)
    return b"".join((
        MAGIC,
        struct.pack("<4q", len(doc_ids), len(values), len(offsets) - 1, len(words)),
        bytes(i is None for i in doc_ids),
        np.array([i or 0 for i in doc_ids], dtype="<i8").tobytes(),
        np.array([len(e) // 4 for e in encoded], dtype="<i8").tobytes(),
        offsets.astype("<u4").tobytes(),
        words.astype("<u8").tobytes(),
    ))


def from_bytes(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, how many ids each document has, and all ids in a row."""
    if payload[:4] != MAGIC:
        raise ValueError("not a shard of Simple-8b words")
    docs, ids, blocks, words = struct.unpack_from("<4q", payload, 4)
    at = 36
    null = payload[at : at + docs]
    names = np.frombuffer(payload, "<i8", docs, at + docs).tolist()
    sizes = np.frombuffer(payload, "<i8", docs, at + 9 * docs)
    values = simple8b.unpack(np.frombuffer(payload, "<u8", words, at + 17 * docs + 4 * (blocks + 1))).astype("<u4")
    if len(values) != ids:
        raise ValueError("a shard is damaged")
    return [None if flag else name for flag, name in zip(null, names)], sizes, values


def ids_of(payload: bytes, place: int) -> np.ndarray:
    """The ids of the document at a place of a shard; only the blocks that hold them are decoded."""
    if payload[:4] != MAGIC:
        raise ValueError("not a shard of Simple-8b words")
    docs, _, blocks, _ = struct.unpack_from("<4q", payload, 4)
    ends = np.cumsum(np.frombuffer(payload, "<i8", docs, 36 + 9 * docs))
    start, end = (int(ends[place - 1]) if place else 0), int(ends[place])
    first, last = start // simple8b.BLOCK, -(-end // simple8b.BLOCK)
    at = 36 + 17 * docs
    offsets = np.frombuffer(payload, "<u4", blocks + 1, at).astype(np.int64)
    words = np.frombuffer(payload, "<u8", int(offsets[last] - offsets[first]), at + 4 * (blocks + 1) + 8 * int(offsets[first]))
    return simple8b.unpack(words)[start - first * simple8b.BLOCK : end - first * simple8b.BLOCK].astype("<u4")


def write(df: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode the whole texts of ``df`` and write them to a container at ``path``."""
    vocabulary = vocabulary or default_path()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode, seq = TaskContext.get().partitionId(), encoder(vocabulary).encode, 0
        names: list[int | None] = []
        encoded: list[bytes] = []

        def shard() -> pa.RecordBatch:
            n = sum(map(len, encoded)) // 4
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(names)], "n_ids": [n], "payload": [to_bytes(names, encoded)]}
            )

        filled = 0
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                names.append(name)
                encoded.append(encode(body.as_py()) + END)
                filled += len(encoded[-1]) // 4
                if filled >= shard_ids:
                    yield shard()
                    names, encoded, filled, seq = [], [], 0, seq + 1
        if names:
            yield shard()

    rows = df.select(column(df, doc_id).cast("long").alias("doc_id"), column(df, text).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.mapInArrow(shards, SHARDS).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: its id, the ids of all documents before it, its number of ids and their CRC-32."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(i) for i in range(3))):
                names, sizes, values = from_bytes(payload.as_py())
                raw, ends = memoryview(values.tobytes()), np.cumsum(sizes)
                sums = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist())]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(names, pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                    names=["part", "seq", "place", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(SHARDS).parquet(path)
    docs = files.select("part", "seq", "payload").mapInArrow(records, RECORDS)
    # Ids before a shard: those of earlier parts (one row a part), and of earlier shards of its part.
    upto = (Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(*upto)), F.lit(0)).alias("base"))
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(*upto)), F.lit(0))
    places = files.select("part", "seq", within.alias("within")).join(parts, "part")
    docs = docs.join(places, ["part", "seq"])
    return docs.select("doc_id", (F.col("base") + F.col("within") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
