"""The operators again, one document at a time in plain Python, and the rows that are hard to get right."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000)) + "."
COPY = " ".join(f"same{i}" for i in range(60)) + "."
NEAR = COPY.replace("same30", "other")
HARD = [
    # doc_id, text, lang, source, n_chars
    (1, COPY, "en", "a", 1),
    (2, COPY, "en", "b", 1),
    (3, NEAR, "en", "c", 1),
    (3, NEAR, "en", "c", 1),
    (4, None, "en", "a", None),
    (5, "", None, "a", 0),
    (6, " \t\n\x0b\x0c\r ", "en", None, 7),
    (7, LONG, "de", None, 2),
    (8, "x" * 50_000, "de", "é", 2),
    (9, "One two.", "en", "a", 2),
    (10, "one  TWO.", "en", "a", 2),
    (11, "Ärger ärger\x1fa\x85b c 日本語 <|endoftext|> it's 12²", "de", "zz", 9),
    (None, COPY, "en", "a", 1),
    (None, "a line that many sites share\nunlike " + COPY, "en", "a", 1),
    (13, "a line that many sites share\nand something of its own here", "en", "b", 1),
    (14, "a line that many sites share", "en", "c", 1),
    (15, " a line that many sites share \n\nlast words of this text", "en", "d", 1),
    (16, "a line that many sites share\n" * 3, "en", "e", 1),
    (17, "again and again and again and again", "en", "e", 1),
    (-18, "tail " + COPY, "en", "a", 1),
    (19, "ANOTHER TEXT SHOUTS!!\nSome | Nav | Bar | Here\nPlain prose stays.", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["row", "size", "k1", "k2", "packed", "whole", "name", "hash", "key", "node", "sign", "u", "n", "facts", "n_lines", "n_removed", "kept", "__text", "again", "gone", "copies", "a.b", "bad `name`"]


def hard(spark, clashes: bool = True):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(HARD, SCHEMA).repartition(3)
    return rows.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)]) if clashes else rows


def words(text):
    return (text or "").encode().split()


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text, length):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + length]) for i in range(len(w) - length + 1)) if len(w) >= length else frozenset([tuple(w)] if w else [])


def near_duplicates(texts, length, percent):
    """Place to (set size, least place reachable) for a list of texts."""
    sets = [shingle_set(t, length) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    links = []
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links.append((i, j))
    found = classes(range(len(texts)), links)
    return [(len(sets[i]), found[i]) for i in range(len(texts))]


def earlier_passages(texts, window):
    """For texts in order: words, removed words, digest of what is left."""
    seen, out = set(), []
    for text in texts:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        left = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return out


def ids(text):
    """The tokenizer's own ids of a whole text and the end id."""
    from tokenizers import Tokenizer

    from marigold.llm.tokens import default_path

    if not hasattr(ids, "tokenizer"):
        ids.tokenizer = Tokenizer.from_file(default_path())
        ids.tokenizer.encode_special_tokens = True
    return ids.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def crc(values):
    return zlib.crc32(np.array(values, dtype="<u4").tobytes())


def quality(text):
    """The base counts of the line-first rules."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if x.encode().split()]
    met = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if met[tuple(w[i : i + 3])] > 1 for k in range(3)}
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, len(b"".join(w).decode()), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed
