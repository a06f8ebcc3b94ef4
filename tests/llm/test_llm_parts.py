"""The parts that operators are made of."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from marigold.llm import hashing, minhash, packing, simple8b, token_files, tokens
from marigold.llm.components import components


@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_256), st.integers(0, 2**32 - 1), st.integers(0, 2**60 - 1)), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_simple8b_round_trip(values):
    words, offsets = simple8b.pack(np.array(values, dtype=np.uint64))
    assert simple8b.unpack(words).tolist() == values
    for i in range(len(offsets) - 1):
        assert simple8b.unpack(words[offsets[i] : offsets[i + 1]]).tolist() == values[i * simple8b.BLOCK : (i + 1) * simple8b.BLOCK]


def test_shards_round_trip_and_damage():
    encoded = [np.array(v, "<u4").tobytes() for v in ([5, 0], [0], list(range(5000)))]
    payload = token_files.to_bytes([7, None, -3], encoded)
    names, sizes, values = token_files.from_bytes(payload)
    assert (names, sizes.tolist(), values.tobytes()) == ([7, None, -3], [2, 1, 5000], b"".join(encoded))
    with pytest.raises(ValueError):
        token_files.from_bytes(b"xxxx" + payload[4:])


@given(st.text(alphabet=st.sampled_from(list("ab Z\n\t\r.,'!1²½éß日\x1c\x1f\x85\xa0 　ªº́<|>_")), max_size=40))
@settings(max_examples=400, deadline=None)
def test_chunks_have_the_ids_of_the_whole(text):
    encoder = tokens.encoder(tokens.default_path())
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == brute.ids(text)[:-1]


def test_encoder_forgets_and_stays_right():
    encoder = tokens.Encoder(tokens.default_path(), remembered=5)
    text = "Some words, some more words.\nAnd then others: it's 12 o'clock!" * 3
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == brute.ids(text)[:-1]
    assert len(encoder) <= 6


@given(st.text(alphabet=st.sampled_from(list("abAB \t\n\x0b\x1f\x85é")), max_size=60), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_hashes_tell_words_and_runs_apart(text, length):
    words = text.encode().split()
    got = hashing.word_hashes(text.encode())
    assert len(got) == len(words)
    names = dict(zip(got.tolist(), words))
    assert [names[h] for h in got.tolist()] == words and len(names) == len(set(words))
    runs = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
    found = hashing.run_hashes(got, length).tolist()
    assert len(found) == len(runs) and len(set(found)) == len(set(runs))
    assert hashing.word_hashes(text.encode(), lower=True).tolist() == hashing.word_hashes(text.encode().lower()).tolist()


def test_estimates_are_close():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    sides = [np.unique(np.concatenate([both, x])) for x in (a, b)]
    signs = [np.frombuffer(minhash.signature(minhash.minima(s)), np.uint64)[None, :] for s in sides]
    assert abs(minhash.estimates(*signs)[0, 0] - 0.8) < 0.1
    assert minhash.similar(*sides, 80) and not minhash.similar(*sides, 81)
    for percent in (50, 80, 85, 95):
        r = minhash.rows_in_band(percent)
        assert (1 - (percent / 100) ** r) ** (minhash.MINIMA // r) <= minhash.MISS


@given(st.lists(st.integers(1, 64), max_size=60))
@settings(max_examples=150, deadline=None)
def test_best_fit_respects_capacity_and_bound(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    bins, offsets = packing.best_fit_decreasing(lengths, 64)
    used = int(bins.max()) + 1 if len(bins) else 0
    assert packing.bin_bound(lengths, 64) <= used
    for b in range(used):
        places = sorted((o, n) for o, n, x in zip(offsets, lengths, bins) if x == b)
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 64


def test_bounds_beyond_volume():
    assert packing.bin_bound(np.array([33] * 10), 64) == 10
    assert packing.bin_bound(np.array([22] * 9), 64) == 5  # two to a bin, volume says 4
    assert packing.bin_bound(np.array([], dtype=np.int64), 64) == 0


def test_exchange_saves_bins(spark):
    random.seed(2)
    data = [(i, random.choice([700, 1300, 1348, 40, 2048])) for i in range(600)]
    rows = spark.createDataFrame(data, "row long, length long").cache()
    alone = packing.place(rows, per_partition=30, rounds=0).select("sequence_id").distinct().count()
    shared = packing.place(rows, per_partition=30).select("sequence_id").distinct().count()
    assert shared < alone
    assert packing.place(rows, per_partition=30).count() == 600


def test_components_of_chains_stars_and_noise(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)]
    edges += [(random.randint(2000, 2400), random.randint(2000, 2400)) for _ in range(180)] + [(5, 5), (1, 0)]
    expected = brute.classes({n for e in edges for n in e}, edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in expected.items() if n in got}
    assert {n for n, c in expected.items() if n not in got} <= {n for n in expected if list(expected.values()).count(expected[n]) == 1}
