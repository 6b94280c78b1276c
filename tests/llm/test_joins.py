"""Operators that compare documents with each other, with a benchmark or with rules."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from clearlot.llm import decontaminate, jaccard_join, line_dedup, linking, suffix_dedup, url_filter
from clearlot.llm.queries import QUERIES, URL_RULES
from tests.llm import brute


def documents(spark, folder):
    return [(row.doc_id, row.text) for row in spark.read.parquet(f"{folder}/documents.parquet").collect()]


# ---------------------------------------------------------------- links


def test_components_are_the_least_members(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, n) for n in range(1001, 1300)]
    pairs += [(n, n + 1) for n in range(2000, 2040)] + [(5, 5)]
    union = brute.Union({one for pair in pairs for one in pair})
    for pair in pairs:
        union.link(*pair)
    made = linking.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {row.id: row.root for row in made} == {
        one: union.root(one) for one in union.above if union.root(one) != one
    }
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_without_all_pairs(spark):
    """A group of one component is done after one round; one without links meets all of its pairs."""
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.where((F.col("a") < 500) & (F.col("b") < 500))

    rows = [(1, n) for n in range(500)] + [(2, n) for n in range(500, 512)] + [(3, 7), (3, 505)]
    roots = linking.link_groups(spark.createDataFrame(rows, "key long, id long"), verify)
    assert roots.where("root = 0").count() == 499
    assert sum(seen) == 499 + 12 * 11 // 2 + 1


# ---------------------------------------------------------------- shingles


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 120), st.integers(0, 14), st.integers(0, 14), st.integers(0, 10**6))
def test_linked_sets_share_a_signature(common, left, right, seed):
    values = np.unique(np.random.default_rng(seed).integers(0, 2**63, common + left + right).astype(np.uint64))
    values = np.random.default_rng(seed + 1).permutation(values)
    one, other = np.sort(values[: common + left]), np.sort(np.concatenate([values[:common], values[common + left :]]))
    for alike in ((90, 100), (80, 100)):
        linked = alike[1] * common >= alike[0] * len(values)
        if linked and len(one) and len(other) and (left or right):
            signer = jaccard_join.Signer(alike)
            assert len(np.intersect1d(signer(one), signer(other)))


@pytest.mark.parametrize(("alike", "size"), [((90, 100), 3), ((80, 100), 5)])
def test_similar_documents_match_brute_force(spark, folder, alike, size):
    docs = documents(spark, folder)
    made = jaccard_join.similar_documents(spark.read.parquet(f"{folder}/documents.parquet"), alike=alike, shingle=size)
    assert sorted(map(tuple, made.collect())) == brute.similar(docs, alike, size)


def test_similar_query_matches_brute_force(spark, folder):
    docs = documents(spark, folder)
    assert sorted(map(tuple, QUERIES["op2_jaccard_join"](spark, folder).collect())) == brute.similar(docs, (90, 100), 3)


def test_similar_edge_documents(make_docs, no_docs, edge_texts):
    rows = [*enumerate(edge_texts)]
    made = jaccard_join.similar_documents(make_docs(rows, clash=True), alike=(80, 100), shingle=5).collect()
    assert sorted(map(tuple, made)) == brute.similar(rows, (80, 100), 5)
    # a repeated row, a row without id that is like row 10, and one that is like no other
    more = make_docs([*rows, (10, edge_texts[10]), (None, edge_texts[10]), (None, "nobody writes this here now")])
    made = jaccard_join.similar_documents(more, alike=(80, 100), shingle=5).collect()
    assert len(made) == len(rows) + 3
    assert sorted(row.component_id or -1 for row in made if row.doc_id is None) == [-1, 10]
    assert jaccard_join.similar_documents(no_docs).count() == 0
    kept = jaccard_join.one_of_each(more)
    assert kept.columns == more.columns
    ids = [row.doc_id for row in kept.collect()]
    wanted = [key for key, size, root in brute.similar(rows, (80, 100), 5) if root == key]
    assert sorted(one for one in ids if one is not None) == sorted(wanted) and ids.count(None) == 1
    assert jaccard_join.one_of_each(no_docs).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 200), st.integers(0, 30), st.integers(0, 30), st.integers(0, 10**6))
def test_parities_differ_no_more_than_sets(common, left, right, seed):
    values = np.random.default_rng(seed).integers(0, 2**63, common + left + right).astype(np.uint64)
    one, other = values[: common + left], np.concatenate([values[:common], values[common + left :]])
    pairs = zip(jaccard_join.parities(one), jaccard_join.parities(other), strict=True)
    assert sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in pairs) <= left + right


def test_large_group_of_copies_is_one_component(spark, sentences):
    base = " ".join(sentences[:8]).split()
    rng = random.Random(9)
    rows = [(n, " ".join(base)) for n in range(300)]
    for n in range(300, 420):
        words = list(base)
        words[rng.randrange(len(words))] = f"w{n}"
        rows.append((n, " ".join(words)))
    made = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), alike=(90, 100), shingle=3)
    assert {row.component_id for row in made.collect()} == {0}


# ---------------------------------------------------------------- benchmark


def test_contamination_query_matches_brute_force(spark, folder):
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    made = QUERIES["op3_decontaminate"](spark, folder).collect()
    assert sorted(map(tuple, made)) == sorted(brute.contamination(documents(spark, folder), items))


def contaminated(docs, items):
    made = decontaminate.contamination(docs, items).collect()
    return [(row.doc_id, row.n_words, row.n_hit, row["items"], row.contaminated) for row in made]


def test_contamination_of_edge_documents(spark, make_docs, no_docs, edge_texts, sentences):
    words = " ".join(sentences[300:304]).split()
    passage = " ".join(words[4:14])
    items = [
        (1, " ".join(words)), (2, "one"), (3, "Two, WORDS"), (4, "same same same"), (5, None), (6, "..."),
        (7, "same " * 25), (8, sentences[22] + " " + sentences[23]), (None, sentences[0]), (1, " ".join(words)),
        (9, passage), (10, "à É x"),
    ]
    rows = [
        *enumerate(edge_texts), (100, passage), (101, "before " + passage.upper() + " after"), (102, " ".join(words[5:14])),
        (103, f"{passage} {passage}"), (104, "one two one"), (None, passage), (100, passage),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS id", "2 AS words", "3 AS item")
    want = brute.contamination(rows, items)
    made = contaminated(make_docs(rows, clash=True), bench)
    told = [(key, n, hit, brute.sha(",".join(names).encode()), bad) for key, n, hit, names, bad in made]
    assert sorted(told, key=repr) == sorted([(w[0], w[1], w[2], w[4], w[5]) for w in want], key=repr)
    docs = make_docs(rows, clash=True)
    left = decontaminate.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted((row.doc_id for row in left.collect()), key=repr) == sorted((w[0] for w in want if not w[5]), key=repr)
    assert contaminated(no_docs, bench) == []
    assert not any(row[4] for row in contaminated(make_docs(rows), bench.limit(0)))
    assert decontaminate.without_contaminated(no_docs, bench).count() == 0


def test_contamination_with_shuffled_joins(spark, make_docs, edge_texts, sentences):
    items = spark.createDataFrame([(1, sentences[0]), (2, "same " * 12)], "item_id long, text string")
    docs = make_docs([*enumerate(edge_texts)])
    one = decontaminate.find_hits(docs, items).collect()
    other = decontaminate.find_hits(docs, items, broadcast_rows=0).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, other), key=repr) and one


def test_no_python_in_decontamination(spark, folder):
    made = decontaminate.contamination(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    )
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- byte strings


def test_suffix_arrays_find_all_windows():
    rng = random.Random(2)
    for _ in range(120):
        window = rng.choice([5, 8, 12])
        base = "".join(rng.choice("ab\0c") for _ in range(60))
        pieces = []
        for _ in range(rng.randrange(1, 40)):
            start = rng.randrange(40)
            pieces.append((base[start : start + window + rng.randrange(8)] + "ab" * window)[: window + rng.randrange(8)].encode())
        ids = np.array([rng.randrange(50) for _ in pieces])
        least = {}
        for piece, number in zip(pieces, ids, strict=True):
            for at in range(len(piece) - window + 1):
                part = piece[at : at + window]
                least[part] = min(least.get(part, 99), number)
        made = suffix_dedup.least_ids(pieces, ids, window, rng.choice([60, 100, 10**6]))
        for piece, found in zip(pieces, made, strict=True):
            assert found.tolist() == [least[piece[at : at + window]] for at in range(len(piece) - window + 1)]


def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(1)
    for size in (1, 2, 9, 200):
        text = rng.integers(1, 3, size).astype(np.uint8)
        order = suffix_dedup.suffix_array(text)
        suffixes = [text[at:].tobytes() for at in order]
        assert suffixes == sorted(suffixes)
        shared = suffix_dedup.common_prefixes(text, order, np.array([0]), np.array([size]), 50)
        for at in range(1, size):
            one, other = suffixes[at - 1], suffixes[at]
            want = next((n for n, (a, b) in enumerate(zip(one, other, strict=False)) if a != b), min(len(one), len(other)))
            assert shared[at] == min(want, 50)


def test_suffix_query_matches_brute_force(spark, folder):
    made = QUERIES["op4_suffix_dedup"](spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, made.collect())) == sorted(brute.without_windows(documents(spark, folder)))


def test_suffix_edge_documents(make_docs, no_docs, edge_texts):
    rows = [*enumerate(edge_texts), (None, edge_texts[21]), (13, edge_texts[13])]
    made = suffix_dedup.digest(suffix_dedup.without_repeats(make_docs(rows, clash=True)))
    made = made.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, made), key=repr) == sorted(brute.without_windows(rows), key=repr)
    assert suffix_dedup.without_repeats(no_docs).count() == 0


# ---------------------------------------------------------------- lines


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=14), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 14), st.sampled_from("abc")), max_size=4))
def test_edit_distance_and_line_keys(one, edits):
    other = list(one)
    for kind, at, char in edits:
        if kind == 0:
            other.insert(at, char)
        elif at < len(other):
            other[at : at + 1] = [char] if kind == 1 else []
    other = "".join(other)
    for most in range(4):
        assert line_dedup.within(one, other, most) == brute.near(one, other, most)
        if brute.near(one, other, most):
            words = zip(line_dedup.parities(one), line_dedup.parities(other), strict=True)
            differ = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in words)
            assert differ <= line_dedup.PAIRS_OF_AN_EDIT * most
    if one != other and brute.near(one, other, 2) and min(len(one), len(other)) >= 4:
        short, long = sorted((one, other), key=len)
        keys, own = line_dedup.line_keys(short, 2, 4)
        more, theirs = line_dedup.line_keys(long, 2, 4)
        met = {key for key, flag in zip(keys, own, strict=True) if flag} & set(more)
        back = {key for key, flag in zip(more, theirs, strict=True) if flag} & set(keys)
        assert met or (len(one) == len(other) and back)


def test_lines_query_matches_brute_force(spark, folder):
    docs = documents(spark, folder)
    gone, texts = brute.repeated_lines(docs), dict(docs)
    for row in QUERIES["op10_line_dedup"](spark, folder).collect():
        lines = texts[row.doc_id].split("\n")
        assert row.removed == gone.get(row.doc_id, []) and row.n_lines == len(lines)
        assert row.text == "\n".join(line for at, line in enumerate(lines) if at not in row.removed)


def test_lines_of_edge_documents(make_docs, no_docs, edge_texts):
    rows = [*enumerate(edge_texts)]
    docs = make_docs(rows, clash=True).drop("removed")
    gone = brute.repeated_lines(rows)
    made = line_dedup.without_repeated_lines(docs)
    assert made.columns == [*docs.columns, "n_lines", "removed"]
    for row in made.collect():
        assert (row.removed or []) == gone.get(row.doc_id, [])
        assert row.text is not None or edge_texts[row.doc_id] is None
    # a row without an id comes first; a repeated row loses what the first one loses
    more = make_docs([(5, "x" * 30 + "\nshort"), (None, "x" * 29 + "y"), (5, "x" * 30 + "\nshort"), (6, "x" * 31)])
    made = [(row.doc_id, row.text) for row in line_dedup.without_repeated_lines(more).collect()]
    assert sorted(made, key=repr) == sorted([(5, "short"), (5, "short"), (None, "x" * 29 + "y"), (6, "")], key=repr)
    assert line_dedup.without_repeated_lines(no_docs).count() == 0


# ---------------------------------------------------------------- URLs


def rule_of(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        ends = [rest.find(char) for char in "/?#" if char in rest]
        cut = min(ends, default=len(rest))
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(char) for char in "?#" if char in path], default=len(path))]
    fits = [
        rule
        for rule in URL_RULES
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
    ]
    best = max(fits, key=lambda rule: len(rule.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_listed_rules(spark, folder):
    urls = [
        None, "", "no scheme", "http://", "http://X.Example.COM/en/a?b#c", "https://www.example.com/en/", "a://net/fr/",
        "a://planet/fr/", "a://x.net/es", "a://x.net/es/?q", "a://com", "a://b.com?x=/en/", "x://y://z/en/", "a://example.com/en/",
    ]
    pages = spark.createDataFrame([(n, url) for n, url in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([], "id long, verdict string")
    made = url_filter.judge_urls(pages.selectExpr("*", "1 AS rule", "2 AS tokens"), labels, URL_RULES).collect()
    for row in made:
        host, path, rule, verdict = rule_of(urls[row.page_id])
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict or "allow"), urls[row.page_id]
    assert len(made) == len(urls)
    assert url_filter.judge_urls(pages.limit(0), labels, URL_RULES).count() == 0
    given = {row.page_id: row.url for row in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for row in QUERIES["op7_url_filter"](spark, folder).collect():
        host, path, rule, verdict = rule_of(given[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")


def test_mined_rules_against_all_combinations(spark):
    rng = random.Random(4)
    urls = [f"http://{rng.choice(['a', 'b'])}.{rng.choice(['x', 'y'])}.org/{rng.choice('pqr')}/{n}" for n in range(300)]
    bad = [("a.x" in url and "/p/" in url) or ("b.y" in url and rng.random() < 0.9) for url in urls]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    tokens = {row.page_id: row.tokens for row in pages.select("page_id", url_filter.tokens_of(F.col("url")).alias("tokens")).collect()}
    rows = [(n, "block" if one else "allow") for n, one in enumerate(bad)]
    labels = spark.createDataFrame([*rows, (None, "block"), (1, None)], "id long, verdict string")
    rules = {}
    for n, verdict in rows:
        for chosen in range(1, 1 << len(tokens[n])):
            rule = frozenset(t for at, t in enumerate(tokens[n]) if chosen >> at & 1)
            rules.setdefault(rule, []).append(verdict)
    known = []
    for rule, verdicts in rules.items():
        for verdict in ("allow", "block"):
            share = verdicts.count(verdict) / len(verdicts)
            if verdicts.count(verdict) >= 0.005 * len(rows) and share >= 0.75:
                known.append((share, verdicts.count(verdict) / len(rows), rule, verdict))
    for row in url_filter.judge_urls(pages, labels, []).collect():
        fits = [one for one in known if one[2] <= set(tokens[row.page_id])]
        best = max((one[:2] for one in fits), default=None)
        wanted = {one[3] for one in fits if one[:2] == best} or {"allow"}
        assert row.verdict in wanted and (row.mined_rule is not None) == bool(fits)


def test_rules_match_alike_when_shuffled(spark):
    sets = spark.createDataFrame([(["a", "b"],), (["b"],), (["c"],)], "tokens array<string>")
    rules = spark.createDataFrame(
        [(["a", "b"], "block", 0.9, 0.1), (["b"], "allow", 0.8, 0.5), (["a", "d"], "block", 1.0, 0.1)],
        "tokens array<string>, verdict string, confidence double, support double",
    )
    for limit in (0, 10):
        made = url_filter.match_rules(sets, rules, limit).collect()
        assert sorted((row.tokens, row.mined) for row in made) == [(["a", "b"], "block"), (["b"], "allow")]


# ---------------------------------------------------------------- pipeline


def test_stages_match_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    first = steps["language"](spark, docs, folder)
    kept = {row.doc_id: row.text for row in first.collect()}
    assert first.columns == docs.columns and len(kept) >= 0.99 * docs.count()
    second = steps["lines"](spark, first, folder)
    gone = brute.repeated_lines(list(kept.items()))
    texts = {}
    for key, text in kept.items():
        left = "\n".join(line for at, line in enumerate(text.split("\n")) if at not in gone.get(key, []))
        if key not in gone or left.strip():
            texts[key] = left
    assert {row.doc_id: row.text for row in second.collect()} == texts
    assert all(row.n_chars == len(row.text) for row in second.collect())
    third = steps["near_duplicates"](spark, second, folder)
    texts = {key: texts[key] for key, _, root in brute.similar(list(texts.items()), (80, 100), 5) if root == key}
    assert {row.doc_id: row.text for row in third.collect()} == texts
    fourth = steps["decontaminate"](spark, third, folder)
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {row[0] for row in brute.contamination(list(texts.items()), items) if not row[5]}
    assert {row.doc_id for row in fourth.collect()} == clean and fourth.columns == docs.columns
    last = steps["tokens"](spark, fourth, folder).collect()
    assert {row.doc_id: row.decoded_sha256 for row in last} == {key: brute.sha(texts[key].encode()) for key in clean}
    assert sorted(row.doc_id for row in corpus_pipeline.run(spark, folder).collect()) == sorted(clean)


def test_stages_with_edge_documents(spark, folder, make_docs, no_docs, edge_texts):
    rows = [*enumerate(edge_texts), (None, edge_texts[13]), (4, edge_texts[21])]
    for docs in (make_docs(rows), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, folder)
            assert name == "tokens" or docs.columns == before.columns
        assert docs.count() <= len(rows)
