"""Byte-level BPE through sentencepiece, from a vocabulary of ranks, and back to bytes.

The vocabulary (one token and its rank a line, the token in base 64) becomes a sentencepiece model that is written here
field by field: the piece of a token is its bytes, each as the visible letter that stands for it; its score is the
negative rank, so that the pair merged next is the pair of least rank; text is not normalised and gets no blank put
before it. Piece i is the token of rank i, so pieces and ids are the same numbers. Every match of the pre-token pattern is encoded
by itself. One that is a token as a whole is that token, whether merges lead to it or not.

Decoding is the inverse: id to piece, letters to bytes. The bytes of a text come back as they were, whatever they are.

A text is taken apart before each run of white space, where the pattern always ends a match, and each worker keeps the
ids of the chunks it has met, up to a fixed number. Long texts pass in segments cut at such places, so that a task
holds the ids of one segment; a run without white space is never cut (a word of four million letters took 300 MB and 3 s).

Defined cases: a null text is as an empty one, it has no ids and decodes to no bytes (``encode`` gives an empty list);
repeated rows and equal ids give equal rows; an empty table gives an empty table; other columns are not looked at,
whatever their names. ``decode`` takes a null list for an empty one and raises for an id that the vocabulary does not have.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marigold.llm.text import column, fresh
from marigold.llm.tokens import BLANKS, CHUNK, byte_letters

REMEMBERED = 600_000
SEGMENT = 1 << 20
CUT = re.compile(f"(?<=[^{BLANKS}])[{BLANKS}]")

# Letters and numbers that the ``regex`` library has and the tokenizer's older Unicode tables have not.
NEWER_LETTERS = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168"
    "\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
NEWER_NUMBERS = "\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"

# Field numbers and kinds of the sentencepiece model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, BPE = 3, 2
NAME, DUMMY_PREFIX, EXTRA_BLANKS, ESCAPE_BLANKS = 1, 3, 4, 5


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a vocabulary file in the order of their ranks, which must be 0, 1, 2 and so on."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, lines)))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("the ranks of a vocabulary must be 0, 1, 2 and so on")
    return [token for _, token in ranked]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece i is ``tokens[i]``; the piece after the last one is the unknown one."""
    letters = byte_letters()

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _block(PIECE, text.encode()) + _varint(SCORE << 3 | 5) + struct.pack("<f", score) + _number(KIND, kind)
        return _block(PIECES, body)

    pieces = [piece("".join(letters[b] for b in token), -float(rank), NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(piece("<unk>", -float(len(tokens)), UNKNOWN))
    flags = b"".join(_number(flag, 0) for flag in (DUMMY_PREFIX, EXTRA_BLANKS, ESCAPE_BLANKS))
    return b"".join(pieces) + _block(TRAINER, _number(MODEL_TYPE, BPE)) + _block(NORMALIZER, _block(NAME, b"identity") + flags)


def exact_pattern(pattern: str) -> str:
    """The pattern with the letters and numbers that the tokenizer knows, for texts that hold newer ones."""
    return "(?V1)" + pattern.replace(r"\p{L}", rf"[\p{{L}}--[{NEWER_LETTERS}]]").replace(r"\p{N}", rf"[\p{{N}}--[{NEWER_NUMBERS}]]")


class Codec(dict):
    """Chunk of a text to its ids, as unsigned 32-bit integers in a row. Forgets everything when it is full."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        import regex
        import sentencepiece

        super().__init__()
        self.tokens = read_ranks(path)
        self.whole = {token: array("I", [rank]).tobytes() for rank, token in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.letters = dict(enumerate(byte_letters()))
        self.common, self.exact = regex.compile(pattern).findall, regex.compile(exact_pattern(pattern)).findall
        self.newer = re.compile(f"[{NEWER_LETTERS}{NEWER_NUMBERS}]").search
        self.names = [str(rank) for rank in range(len(self.tokens))]
        self.remembered = remembered

    def __missing__(self, chunk: str) -> bytes:
        split = self.common if chunk.isascii() or not self.newer(chunk) else self.exact
        ids = b"".join([self._pre_token(match) for match in split(chunk)])
        if len(self) >= self.remembered:
            self.clear()
        self[chunk] = ids
        return ids

    def _pre_token(self, match: str) -> bytes:
        raw = match.encode()
        known = self.whole.get(raw)
        if known is None:
            known = array("I", self.model.encode(raw.decode("latin-1").translate(self.letters))).tobytes()
        return known

    def encode(self, text: str | None) -> Iterator[np.ndarray]:
        """The ids of a whole text, segment by segment."""
        at, text = 0, text or ""
        while at < len(text):
            cut = CUT.search(text, at + SEGMENT) if len(text) - at > SEGMENT else None
            end = cut.start() if cut else len(text)
            yield np.frombuffer(b"".join(map(self.__getitem__, CHUNK.findall(text[at:end]))), dtype=np.uint32)
            at = end

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """How many ids a text has, and the SHA-256 of the ids as decimals and of the bytes that they decode to."""
        n, decimals, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for part in self.encode(text):
            ids = part.tolist()
            decimals.update(((("," if n else "") + ",".join(map(self.names.__getitem__, ids))) if ids else "").encode())
            decoded.update(self.decode(ids))
            n += len(ids)
        return n, decimals.hexdigest(), decoded.hexdigest()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a vocabulary; it outlives a task where Spark uses its workers again."""
    return Codec(path, pattern)


def _mapped(df: DataFrame, source: str, keep: tuple[str, ...], out: tuple[tuple[str, str], ...], body) -> DataFrame:
    """``keep`` and the columns ``out`` (name, type) that ``body`` makes of each batch of ``source``."""
    rows = df.select(column(df, source), *[column(df, c) for c in keep])
    names = [f"c{i}" for i in range(len(rows.columns))]
    kinds = [f.dataType.simpleString() for f in rows.schema]
    rows = rows.toDF(*names)
    made = fresh(rows, *[name for name, _ in out])
    schema = ", ".join([f"{n} {t}" for n, t in zip(names[1:], kinds[1:])] + [f"{n} {t}" for n, (_, t) in zip(made, out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *body(batch.column(0))], names=[*names[1:], *made])

    done = rows.mapInArrow(run, schema)
    return done.toDF(*keep, *[name for name, _ in out])


def encode(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``keep`` and ``ids``, the ids of each whole text."""
    vocabulary, pattern = vocabulary or default_path(), pattern or default_pattern()

    def body(texts: pa.Array) -> list[pa.Array]:
        own = codec(vocabulary, pattern)
        ids = [np.concatenate([np.zeros(0, np.uint32), *own.encode(t.as_py())]).astype(np.int32) for t in texts]
        return [pa.array(ids, pa.list_(pa.int32()))]

    return _mapped(df, text, keep, (("ids", "array<int>"),), body)


def decode(
    df: DataFrame, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``keep`` and ``bytes``, what each list of ids stands for."""
    vocabulary, pattern = vocabulary or default_path(), pattern or default_pattern()

    def body(lists: pa.Array) -> list[pa.Array]:
        own = codec(vocabulary, pattern)
        return [pa.array([own.decode(i.as_py() or ()) for i in lists], pa.binary())]

    return _mapped(df, ids, keep, (("bytes", "binary"),), body)


def round_trip(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``keep`` and what encoding and decoding each whole text gives: ``n_tokens, ids_sha256, decoded_sha256``."""
    vocabulary, pattern = vocabulary or default_path(), pattern or default_pattern()

    def body(texts: pa.Array) -> list[pa.Array]:
        own = codec(vocabulary, pattern)
        found = [own.digest(t.as_py()) for t in texts]
        return [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]

    return _mapped(df, text, keep, (("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")), body)
