"""Token ids of whole texts by a byte-level BPE of the tokenizers library, inside Spark's tasks.

A text is taken apart before each run of white space. No token of the byte-level pattern holds a non-blank
followed by a blank, and no choice of the pattern looks further than the blanks it stands in, so the ids of a
text are the ids of these chunks in a row. Added tokens (``<|endoftext|>``) that stand in a text get their own id, as
the library gives it by default; they hold no blank, so no cut falls into one. Invented or not, words repeat: each worker keeps the ids of the chunks
it has met, up to a fixed number, and asks the library for new ones only.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable
from functools import lru_cache
from operator import attrgetter

# Unicode's White_Space, which the tokenizer's pattern means by a blank.
BLANKS = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")
# Plain words of Latin letters are cut from the marks that close them and from the line break before them: words repeat
# more often than words with marks do.
MARKS, LATIN = ".,!?;:", "A-Za-zÀ-ÖØ-öø-ÿ"
FINE = re.compile(f" ?[{LATIN}]+(?=[{MARKS}]*(?:[{BLANKS}]|\\Z))|[{MARKS}]+(?=[{BLANKS}]|\\Z)|\n(?=[{LATIN}])|{CHUNK.pattern}")
WORD = re.compile(f" ?[{LATIN}]+")
PLAIN_LETTERS = re.compile(f"[\n {LATIN}{MARKS}]+")
REMEMBERED = 400_000
ID, BIG = attrgetter("id"), sys.byteorder == "big"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible, else the next free one from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in visible]
    letters = dict(zip(visible, map(chr, visible))) | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Encoder(dict):
    """Chunk to its ids, as little-endian unsigned 32-bit integers. Forgets everything when it is full."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # Plain words are taken apart here, unless an added token could be one or a part of one.
        self.plain = not any(PLAIN_LETTERS.fullmatch(token) for token in added)
        self.chunks = (FINE if self.plain else CHUNK).findall
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.blank = self.letters[32]
        self.remembered = remembered

    def __missing__(self, chunk: str) -> bytes:
        ids = self._ids(chunk)
        if len(self) >= self.remembered:
            self.clear()
        self[chunk] = ids
        return ids

    def _ids(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[0] == " " else chunk
        if self.plain and word.isascii() and word.isalpha():
            return self.pack(map(ID, self.tokenize(word if word is chunk else self.blank + word)))
        if self.plain and WORD.fullmatch(chunk):
            return self.pack(map(ID, self.tokenize(chunk.encode().decode("latin-1").translate(self.letters))))
        return self.pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    @staticmethod
    def pack(ids: Iterable[int]) -> bytes:
        packed = array("I", ids)
        if BIG:
            packed.byteswap()
        return packed.tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; none for null."""
        return b"".join(map(self.__getitem__, self.chunks(text))) if text else b""


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary; it outlives a task where Spark uses its workers again."""
    return Encoder(path)
