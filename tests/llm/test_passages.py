"""Repeated passages against a plain version, and the parts that the operator rests on."""

import random
import re

import numpy as np
import pytest

from clearlot.llm import queries, substring_dedup
from clearlot.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window=20):
    """(id, words, removed words, what is left) of rows with distinct ids or repeated rows."""
    seen, gone = {}, {}
    for key, text in sorted(set(rows), key=lambda row: (row[0] is None, row[0] or 0)):
        words = WORD.findall(text or "")
        lost = gone[key] = set()
        for at in range(len(words) - window + 1):
            passage = tuple(words[at : at + window])
            if passage in seen:
                lost.update(range(at, at + window))
            seen.setdefault(passage, key)
    made = []
    for key, text in rows:
        words = WORD.findall(text or "")
        left = " ".join(word for at, word in enumerate(words) if at not in gone[key])
        made.append((key, len(words), len(gone[key]), left))
    return sorted(made, key=repr)


def result(frame):
    return sorted((tuple(row) for row in frame.select("doc_id", "n_words", "n_removed", "kept").collect()), key=repr)


def test_covers_give_every_distance():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert substring_dedup.period_for(20) == 13


def test_query_matches_plain_version(spark, folder):
    docs = table(spark, folder, "documents")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert result(substring_dedup.without_repeated_passages(docs)) == plain(rows)
    assert queries.QUERIES["op11_substring_dedup"](spark, folder).count() == len(rows)


def test_edge_texts(spark, make_docs, edge_texts):
    rows = list(enumerate(edge_texts))
    rows += [(40, edge_texts[21]), (40, edge_texts[21]), (None, edge_texts[21]), (3, None)]
    rows.remove((3, edge_texts[3]))
    found = substring_dedup.without_repeated_passages(make_docs(rows, clash=True).repartition(7))
    assert result(found) == plain(rows)


@pytest.mark.parametrize("window", [3, 7, 20, 40])
def test_passages_at_every_shift(spark, make_docs, window):
    rng = random.Random(window)
    passage = [f"p{at}" for at in range(window + 5)]
    rows = []
    for key in range(60):
        before = [f"b{rng.random()}" for _ in range(key)]
        cut = passage[rng.randrange(3) : len(passage) - rng.randrange(4)]
        rows.append((key, rng.choice([" ", "\t", "\n ", "\r\n"]).join([*before, *cut, f"e{key}"])))
    found = substring_dedup.without_repeated_passages(make_docs(rows), window=window)
    assert result(found) == plain(rows, window)


def test_long_texts_are_cut_between_words(spark, make_docs, monkeypatch):
    rng = random.Random(3)
    words = ["w" * rng.randrange(1, 9) + str(rng.randrange(50)) for _ in range(4000)]
    texts = [" ".join(words), " ".join(words[1000:2000]), "x" * 3000 + " " + " ".join(words[5:60])]
    hashes = []
    for size in (1 << 20, 700):
        monkeypatch.setattr(substring_dedup, "CHUNK", size)
        hashes.append([substring_dedup.Chunk(substring_dedup.Hasher(), [t.encode()]).lanes for t in texts])
    assert all((one == other).all() for one, other in zip(*hashes, strict=True))
    monkeypatch.undo()
    rows = list(enumerate(texts))
    assert result(substring_dedup.without_repeated_passages(make_docs(rows))) == plain(rows)


def test_same_words_have_same_hashes():
    texts = ["ä b  ab\x00c\tab b ä".encode(), b"", b" \n", b"ab\x00c b"]
    chunk = substring_dedup.Chunk(substring_dedup.Hasher(), texts)
    assert chunk.count.tolist() == [6, 0, 0, 2] and chunk.at.tolist() == [0, 1, 2, 3, 4, 5, 0, 1]
    for lane in chunk.lanes:
        assert lane[0] == lane[5] and lane[1] == lane[4] == lane[7] and lane[2] == lane[6]
        assert len(np.unique(lane)) == 4


def test_no_documents(spark, no_docs):
    assert substring_dedup.digests(substring_dedup.without_repeated_passages(no_docs)).collect() == []


def test_ids_of_rows_differ(spark, make_docs):
    words = " ".join(f"w{at}" for at in range(30))
    found = result(substring_dedup.without_repeated_passages(make_docs([(1, words), (1, "z " + words), (2, words)])))
    assert sum(row[2] == 0 for row in found) == 1 and [row[2] for row in found if row[0] == 2] == [30]
