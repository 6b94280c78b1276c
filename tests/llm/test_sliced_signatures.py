"""Signatures, members and pairs are taken in slices, and the largest intermediate table goes when it is no longer read."""

import os
import random

import numpy as np
import pytest

from clearlot.llm import jaccard_join, linking
from tests.llm import brute


def texts_with_copies(sentences):
    rng = random.Random(4)
    rows = []
    for n in range(60):
        words = " ".join(sentences[n * 4 : n * 4 + 4]).split()
        rows.append((3 * n, " ".join(words)))
        words[rng.randrange(len(words))] = "other"
        rows.append((3 * n + 1, " ".join(words)))
        rows.append((3 * n + 2, " ".join(words[: len(words) * 3 // 4])))
    return rows


def test_slices_lose_no_link_and_shuffle_a_part_at_a_time(spark, make_docs, sentences, monkeypatch):
    rows = texts_with_copies(sentences)
    taken, wide = [], []

    def noting(made, label):
        taken.append(label)
        if label == "signatures":
            wide.extend(made.inputFiles())
        return made

    for name in ("staged", "staged_small"):
        write = getattr(jaccard_join, name)
        monkeypatch.setattr(jaccard_join, name, lambda frame, label, write=write: noting(write(frame, label), label))
    monkeypatch.setattr(jaccard_join, "SIGNS_AT_ONCE", 1)
    monkeypatch.setattr(jaccard_join, "PAIRS_AT_ONCE", 1)
    monkeypatch.setattr(linking, "MEMBERS_AT_ONCE", 1)
    made = jaccard_join.similar_documents(make_docs(rows), alike=(80, 100), shingle=5).collect()
    assert sorted(map(tuple, made)) == brute.similar(rows, (80, 100), 5)
    assert taken.count("shared") == taken.count("shares") == jaccard_join.SLICES
    assert taken.count("reached") >= jaccard_join.SLICES
    assert wide and not any(os.path.exists(file.removeprefix("file://")) for file in wide)


def test_each_signature_lies_in_one_slice():
    signs = np.unique(np.random.default_rng(2).integers(0, 2**64, 5_000, dtype=np.uint64))
    signs = np.unique(np.concatenate([signs, np.array([0, 2**61 - 1, 2**61, 2**63, 2**64 - 1], np.uint64)]))
    parts = jaccard_join.sliced(signs)
    assert len(parts) == jaccard_join.SLICES
    assert (np.concatenate(parts).view(np.uint64) == signs).all()
    for at, part in enumerate(parts):
        assert (part.view(np.uint64) >> np.uint64(61) == at).all()
    assert [len(part) for part in jaccard_join.sliced(np.zeros(0, np.uint64))] == [0] * jaccard_join.SLICES


@pytest.mark.parametrize("seed", range(20))
def test_cells_differ_no_more_than_sets(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2**63, 300_000 if seed == 0 else int(rng.integers(3, 4_000))).astype(np.uint64)
    left, right = rng.integers(0, len(values), 2)
    one, other = values[:left], values[right:]
    apart = np.abs(jaccard_join.cells(one).astype(int) - jaccard_join.cells(other).astype(int)).sum()
    assert apart <= len(np.setxor1d(one, other))
