"""Ranked documents against a plain version that scores all of them."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import UPPER
from clearlot.llm import queries, ranked_search
from clearlot.llm.common import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return Counter(TERM.findall((text or "").translate(UPPER)))


def plain(docs, items, places=20):
    counted = [(key, split(text)) for key, text in docs]
    counted = [(key, held) for key, held in counted if held]
    total, length = len(counted), sum(held.total() for _, held in counted)
    df = Counter(term for _, held in counted for term in held)
    weight = {term: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for term, n in df.items()}
    made = []
    for item, text in dict.fromkeys(items):
        found = []
        for key, held in counted:
            m = 100 - 25 + (25 * held.total() * total) // length
            score = sum(n * weight[term] * ((10**9 * held[term]) // (1000 * held[term] + 12 * m))
                        for term, n in split(text).items() if term in held)
            if score > 0:
                found.append((-score, key is None, key))
        made += [(item, rank, one[2], -one[0]) for rank, one in enumerate(sorted(found)[:places], 1)]
    return sorted(made, key=repr)


def result(frame):
    return sorted((tuple(row) for row in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_query_matches_plain_version(spark, folder):
    docs = [(row.doc_id, row.text) for row in table(spark, folder, "documents").collect()]
    items = [(row.item_id, row.text) for row in table(spark, folder, "benchmark").collect()]
    assert result(queries.QUERIES["op13_ranked_search"](spark, folder)) == plain(docs, items)


def test_edge_texts(spark, make_docs, edge_texts):
    docs = [*enumerate(edge_texts), (3, "Two words again"), (3, "Two words again"), (None, "two words"), (8, "two words")]
    items = [(1, "TWO words wörds"), (2, None), (3, ""), (4, "!?"), (5, "nowhere-to-be-found"), (6, "a b c a a"),
             (6, "same text"), (6, "same text"), (None, "日本 👍 é"), (9, edge_texts[21])]
    frame = spark.createDataFrame([(*item, 1) for item in items], "item_id long, text string, score int")
    found = ranked_search.search(make_docs(docs, clash=True).repartition(5), frame, places=3)
    assert result(found) == plain(docs, items, 3)


def test_ties_go_to_smaller_ids_whatever_the_partitions(spark, make_docs):
    docs = [(key, "alpha beta" if key % 3 else "gamma") for key in range(200, 0, -1)]
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    for parts in (1, 9):
        found = result(ranked_search.search(make_docs(docs).repartition(parts), items))
        assert [row[2] for row in found if row[1]] == [row[2] for row in plain(docs, [(1, "alpha")])]


def test_nothing_to_search(spark, make_docs, no_docs):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked_search.search(no_docs, items).collect() == []
    for none in (items.where("item_id > 1"), items.withColumn("text", items.text.substr(9, 9))):
        found = ranked_search.search(make_docs([(1, "one")]), none)
        assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_queries_pass_in_blocks(spark, make_docs, sentences, monkeypatch):
    docs = [(at, " ".join(sentences[at : at + 3])) for at in range(0, 90)]
    items = [(at, sentences[at]) for at in range(0, 60, 4)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 600)
    assert len(list(ranked_search._blocks(frame, "item_id", "text"))) > 2
    assert result(ranked_search.search(make_docs(docs), frame, places=5)) == plain(docs, items, 5)


@pytest.mark.parametrize("seed", range(6))
def test_limited_accumulators_keep_the_best_exactly(seed):
    rng = random.Random(seed)
    many = 300
    rows = []
    for at in range(many):
        held = {term: rng.randrange(1, 4) for term in range(40) if rng.random() < 1 / (1 + term % 20)}
        rows.append((at, sum(held.values()), list(held), list(held.values())))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([row[0] for row in rows]), pa.array([max(1, row[1]) for row in rows]),
         pa.array([row[2] for row in rows], pa.list_(pa.int32())), pa.array([row[3] for row in rows], pa.list_(pa.int64()))],
        names=["id", "length", "terms", "counts"],
    )
    weights = np.array([100 + 300 * (term % 20) for term in range(40)], np.int64)
    block = ranked_search.Block(batch, weights, many, sum(max(1, row[1]) for row in rows))
    query = sorted([(term, rng.randrange(1, 3)) for term in rng.sample(range(40), 12)], key=lambda one: -weights[one[0]])
    exact = np.zeros(many, np.int64)
    for number, repeats in query:
        holders, impacts = block.postings(number)
        exact[holders] += impacts * repeats
    best = sorted(exact.tolist(), reverse=True)
    limited = 0
    for floor in (0, best[30], best[5], best[0], best[0] + 1):
        found = ranked_search.scores(block, query, 10, floor)
        needed = max(best[9], floor)
        assert (np.flatnonzero(found >= needed) == np.flatnonzero(exact >= needed)).all()
        assert (found[found >= needed] == exact[exact >= needed]).all()
        limited += int((found < exact).sum())
    assert limited
