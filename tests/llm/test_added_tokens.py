"""Ids of texts that hold the vocabulary's added token, against the library as it is loaded."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from marigold.llm import packing, token_files, tokens
from marigold.staging import scratch_path

LIBRARY = Tokenizer.from_file(tokens.default_path())
TOKEN = "<|endoftext|>"


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_added_token_has_its_own_id():
    encoder = tokens.Encoder(tokens.default_path())
    assert np.frombuffer(encoder.encode(f"see {TOKEN} here"), "<u4").tolist() == [3826, 220, 50256, 994] == ids(f"see {TOKEN} here")


@given(st.lists(st.sampled_from([TOKEN, TOKEN[:-1], "a", "B.", "'s", "12", " ", "  ", "\n", "\t", "\xa0", "é", "日", "<|", "|>"]), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_chunks_with_added_tokens_have_the_ids_of_the_whole(text):
    assert np.frombuffer(tokens.encoder(tokens.default_path()).encode(text), "<u4").tolist() == ids(text)


def test_token_files_and_packing_with_added_tokens(spark):
    texts = [f"see {TOKEN} here", "plain words", f"{TOKEN}{TOKEN}\n end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = {i: len(ids(t)) + 1 for i, t in enumerate(texts)}
    path = scratch_path(spark, "test")
    token_files.write(df, path)
    assert {r["doc_id"]: r["n_tokens"] for r in token_files.read(spark, path).collect()} == sizes
    assert {r["doc_id"]: r["length"] for r in packing.pack(df).collect()} == sizes
