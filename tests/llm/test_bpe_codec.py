"""The byte-level codec against the library it stands for, code point by code point and text by text."""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import lru_cache

import brute
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from __spark_entry__ import queries
from marigold.llm import bpe_codec

VOCABULARY, PATTERN = bpe_codec.default_path(), public_tokenizers.PATTERN


@lru_cache
def library():
    ranks = {token: rank for rank, token in enumerate(bpe_codec.read_ranks(VOCABULARY))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(text):
    return [i for part in bpe_codec.codec(VOCABULARY, PATTERN).encode(text) for i in part.tolist()]


def expected(text):
    own = library().encode_ordinary(text or "")
    decimals, decoded = ",".join(map(str, own)), library().decode_bytes(own)
    return len(own), hashlib.sha256(decimals.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


@pytest.mark.parametrize("lead,kind", [("a", r"\p{L}"), ("1", r"\p{N}"), ("\t", r"\s")])
def test_every_code_point_has_the_kind_that_the_library_gives_it(lead, kind):
    """With only bytes and whole words as tokens, a word is one token exactly if its two characters are of a kind."""
    of_kind = regex.compile(bpe_codec.exact_pattern(kind)).fullmatch
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(points), 100_000):
        part = points[at : at + 100_000]
        ranks = {bytes([b]): b for b in range(256)} | {(lead + chr(c)).encode(): 256 + c for c in part}
        splits = tiktoken.Encoding("kinds", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        assert [c for c in part if (len(splits.encode_ordinary(lead + chr(c))) == 1) != bool(of_kind(chr(c)))] == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \t\n\r\x85\xa0 　'sdtm1՘\U0003d000\U00016ff4\x00\x1c\x1f")))
def test_any_text_has_the_ids_of_the_library(text):
    assert ids(text) == library().encode_ordinary(text)
    assert bpe_codec.codec(VOCABULARY, PATTERN).decode(ids(text)) == text.encode()


@pytest.mark.parametrize("text", ["x" * 50_000, "ab" * 30_000, "日本" * 5_000, " " * 40_000, "\n a" * 700_000 + "b" * 70, "it's 12² we'll'll"])
def test_long_texts_and_segments(text):
    assert ids(text) == library().encode_ordinary(text)


def test_a_small_vocabulary_merges_by_rank(tmp_path):
    """The pair of least rank first, the leftmost of equals; a token that no merge reaches is found as a whole."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"abc", b"aa", b"wxyz"]
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    own = bpe_codec.Codec(str(path), PATTERN, remembered=2)
    plain = tiktoken.Encoding("small", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for text in ("abc", "aaa", "aabc abab", "wxyz", "wxyzz", "aaaaa bcbc"):
        assert [i for part in own.encode(text) for i in part.tolist()] == plain.encode_ordinary(text)
    assert len(own) <= 2
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe_codec.read_ranks(str(path))


def test_hard_rows(spark):
    found = bpe_codec.round_trip(brute.hard(spark))
    assert Counter(map(tuple, found.collect())) == Counter((d, *expected(t)) for d, t, *_ in brute.HARD)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bpe_codec.round_trip(brute.hard(spark).limit(0)).count() == 0


def test_encode_and_decode_are_inverse(spark):
    rows = brute.hard(spark).withColumn("ids", F.lit("taken"))
    coded = bpe_codec.encode(rows, keep=("doc_id", "text", "a.b"))
    back = bpe_codec.decode(coded, keep=("text", "ids", "a.b"))
    for text, own, _, raw in back.collect():
        assert own == library().encode_ordinary(text or "") and bytes(raw) == (text or "").encode()
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe_codec.decode(nothing).first()["bytes"]) == b""


def test_query_over_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = queries()["op13_bpe_codec"](spark, sf_dir).collect()
    assert Counter(map(tuple, found)) == Counter((d, *expected(t)) for d, t in docs)
