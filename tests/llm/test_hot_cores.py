"""op4: cores whose different pieces fill more than a shard are split into single windows."""

from __future__ import annotations

import random

import numpy as np

from clearlot.llm import suffix_dedup
from tests.llm import brute

CORE = "the one string of forty bytes everywhere"


def test_one_core_in_many_surroundings(make_docs):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(30)]
    rows = [(key, f"{rng.choice(words)} {rng.choice(words)}{CORE}{rng.choice(words)} {rng.choice(words)}") for key in range(400)]
    for shard_bytes in (300, 1 << 22):  # with and without hot cores
        docs = make_docs(rows)
        spans = suffix_dedup.repeated_spans(docs, shard_bytes=shard_bytes).collect()
        gone = {row["id"]: {at for span in row["spans"] for at in range(span["first"], span["end"])} for row in spans}
        want = {key: removed for key, _, removed, _, _ in brute.without_windows(rows) if removed}
        assert {key: len(places) for key, places in gone.items()} == want


def test_cores_cover_every_window_once():
    rng = np.random.default_rng(3)
    for size in (49, 50, 51, 66, 67, 400):
        data = rng.integers(97, 99, size).astype(np.uint8)
        cores, first, last = suffix_dedup.pieces_of(data)
        starts = sorted(at for a, b in zip(first.tolist(), last.tolist(), strict=True) for at in range(a, b + 1))
        assert starts == list(range(max(0, size - suffix_dedup.WINDOW + 1)))
        assert len(cores) == len(first)


def test_equal_windows_have_equal_cores():
    rng = np.random.default_rng(4)
    window = rng.integers(97, 123, suffix_dedup.WINDOW).astype(np.uint8)
    found = set()
    for before in (0, 1, 17, 40, 300):
        data = np.concatenate([rng.integers(97, 123, before), window, rng.integers(97, 123, 60)]).astype(np.uint8)
        cores, first, last = suffix_dedup.pieces_of(data)
        found.add(int(cores[(first <= before) & (before <= last)][0]))
    assert len(found) == 1


def test_hashes_of_pieces_tell_them_apart():
    rng = np.random.default_rng(6)
    data = rng.integers(97, 99, 500).astype(np.uint8)
    data = np.concatenate([data, data[:200]])
    first = np.repeat(np.arange(0, 600), 18)
    ends = np.minimum(first + 50 + np.tile(np.arange(18), 600), len(data))
    found = suffix_dedup.piece_hashes(suffix_dedup.gram_hashes(data), first, ends)
    texts = [data[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
    assert len(set(found.tolist())) == len(set(texts)) == len(set(zip(found.tolist(), texts, strict=True)))


def test_texts_together_have_the_pieces_of_each():
    rng = np.random.default_rng(7)
    texts = [rng.integers(97, 100, size).astype(np.uint8) for size in (10, 50, 0, 49, 51, 300, 3, 120, 66, 1, 50)]
    sizes = np.array([len(text) for text in texts])
    cores, first, last = suffix_dedup.pieces_of(np.concatenate(texts), sizes=sizes)
    want, before = [], 0
    for text in texts:
        want += [(c, a + before, b + before) for c, a, b in zip(*map(np.ndarray.tolist, suffix_dedup.pieces_of(text)), strict=True)]
        before += len(text)
    assert sorted(zip(cores.tolist(), first.tolist(), last.tolist(), strict=True)) == sorted(want)


def test_chunks_change_no_window(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.integers(97, 100, size).astype(np.uint8) for size in (400, 10, 64, 63, 65, 700, 50)]
    data, sizes = np.concatenate(texts), np.array([len(text) for text in texts])

    def cores():
        return {
            at: core
            for core, a, b in zip(*map(np.ndarray.tolist, suffix_dedup.pieces_of(data, sizes=sizes)), strict=True)
            for at in range(a, b + 1)
        }

    whole = cores()
    for chunk in (60, 64, 128, 1000):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        assert cores() == whole
        _, first, last = suffix_dedup.pieces_of(data)
        made = suffix_dedup._hashed(data, first, last + suffix_dedup.WINDOW, suffix_dedup.GRAM)
        plain = suffix_dedup.piece_hashes(suffix_dedup.gram_hashes(data), first, last + suffix_dedup.WINDOW)
        assert made.tolist() == plain.tolist()
