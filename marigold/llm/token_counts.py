"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

The model is a vocabulary of byte strings whose scores fall with their rank: ``-log(rank + 2)``, as in Zipf's law, so
that few and frequent pieces win. A pre-token's segmentation is the one with the greatest total score, of equal ones
the one with fewer pieces. The forward score of a prefix (best score and count of pieces up to its end) depends on the
prefix alone. Pre-tokens that a task has not met yet are put into a trie; walking it depth first computes each shared
prefix once, and the nodes where pre-tokens end give their counts. A worker keeps the counts of a bounded
number of pre-tokens; each of a batch's pre-tokens is then looked up once and multiplied by how often a text has it.

Defined cases: null and empty texts have no pre-tokens and no tokens; rows are counted one by one; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from marigold.llm.text import column
from marigold.llm.tokens import CHUNK, byte_letters, default_path

REMEMBERED = 600_000
SLICE = 512


def read_vocabulary(path: str) -> dict[bytes, float]:
    """Piece to score from a byte-level vocabulary file of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        ranks = json.load(file)["model"]["vocab"]
    bytes_of = {letter: byte for byte, letter in enumerate(byte_letters())}
    return {bytes(bytes_of[c] for c in piece): -math.log(rank + 2) for piece, rank in ranks.items() if all(c in bytes_of for c in piece)}


class Trie:
    """A trie of byte strings, kept as its strings in order: to walk them, each from the prefix that it shares with the
    one before, is to walk the trie depth first."""

    def __init__(self, words: Iterable[bytes]):
        self.words = sorted(set(words))

    def walk(self) -> Iterator[tuple[bytes, int]]:
        """Every string, and how many nodes of its path the walk has seen already."""
        before = b""
        for word in self.words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            yield word, shared
            before = word


class Unigram:
    """Forward scores over a trie, for one vocabulary."""

    def __init__(self, scores: dict[bytes, float]):
        missing = [b for b in range(256) if bytes([b]) not in scores]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing}")
        self.scores = scores
        # Which lengths pieces have, by their last two bytes (or the only one): all others need not be tried.
        lengths: dict[bytes, set[int]] = {}
        for piece in scores:
            lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {end: sorted(found) for end, found in lengths.items()}
        self.nodes = 0  # forward scores computed so far

    def counts(self, words: Iterable[bytes]) -> dict[bytes, int]:
        """Pieces in the best segmentation of each word, with one forward step per node of their trie."""
        scores, lengths = self.scores.get, self.lengths.get
        best, pieces = [0.0], [0]  # by depth of the walk: the best score up to there, and its number of pieces
        out = {}
        for word, shared in Trie(words).walk():
            del best[shared + 1 :], pieces[shared + 1 :]
            self.nodes += len(word) - shared
            for end in range(shared + 1, len(word) + 1):
                top, count = best[-1] + scores(word[end - 1 : end]), pieces[-1] + 1
                for length in lengths(word[end - 2 : end], ()) if end > 1 else ():
                    if length > end:
                        break
                    score = scores(word[end - length : end])
                    if score is not None:
                        score += best[end - length]
                        if score > top or (score == top and pieces[end - length] + 1 < count):
                            top, count = score, pieces[end - length] + 1
                best.append(top)
                pieces.append(count)
            out[word] = pieces[-1]
        return out


class Counts:
    """A worker's memory of pre-tokens and their counts; it forgets everything when it is full."""

    def __init__(self, path: str):
        self.model, self.known = Unigram(read_vocabulary(path)), {}

    def add(self, chunks: set[str]) -> None:
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, chunks
        found = self.model.counts({c.encode() for c in new})
        self.known.update((c, found[c.encode()]) for c in new)


@lru_cache(maxsize=2)
def counts(path: str) -> Counts:
    return Counts(path)


def count(df: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_pretokens, n_distinct, n_tokens`` of each whole text."""
    vocabulary = vocabulary or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = counts(vocabulary)
        for whole in batches:
            for start in range(0, len(whole), SLICE):
                batch = whole.slice(start, SLICE)
                met = [Counter(CHUNK.findall(t)) if t else Counter() for t in batch.column(1).to_pylist()]
                memory.add(set().union(*met))
                known = memory.known
                tokens = [sum(known[c] * n for c, n in m.items()) for m in met]
                columns = [[m.total() for m in met], list(map(len, met)), tokens]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_pretokens", "n_distinct", "n_tokens"])

    rows = df.select(column(df, doc_id).alias("doc_id"), column(df, text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_pretokens long, n_distinct long, n_tokens long")
