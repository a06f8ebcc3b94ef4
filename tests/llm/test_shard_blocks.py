"""One document of a shard is read from the blocks that hold it."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from marigold.llm import simple8b, token_files


@given(st.lists(st.integers(0, 1500), min_size=1, max_size=12), st.integers(0, 2**32 - 1))
@settings(max_examples=60, deadline=None)
def test_each_document_alone_equals_all_in_a_row(sizes, seed):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, 2 ** int(rng.integers(1, 32)), n, dtype=np.uint32) for n in sizes]
    payload = token_files.to_bytes([None if i % 3 == 2 else i for i in range(len(docs))], [d.astype("<u4").tobytes() for d in docs])
    _, lengths, values = token_files.from_bytes(payload)
    assert lengths.tolist() == sizes and (values == np.concatenate(docs)).all()
    for place, own in enumerate(docs):
        assert (token_files.ids_of(payload, place) == own).all() and len(token_files.ids_of(payload, place)) == len(own)


def test_other_blocks_are_not_looked_at(monkeypatch):
    docs = [np.arange(5 * simple8b.BLOCK, dtype=np.uint32), np.array([7, 8, 9], np.uint32)]
    payload = token_files.to_bytes([1, 2], [d.tobytes() for d in docs])
    seen = []
    plain = simple8b.unpack
    monkeypatch.setattr(simple8b, "unpack", lambda words: seen.append(len(words)) or plain(words))
    assert token_files.ids_of(payload, 1).tolist() == [7, 8, 9] and seen == [1]
    with pytest.raises(ValueError):
        token_files.ids_of(b"nothing", 0)
