"""Operators that look at one text at a time."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clearlot.llm import byte_pairs, html_extract, language_id, quality_rules, token_files
from clearlot.llm.queries import QUERIES
from tests.llm import brute

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def own():
    return byte_pairs.encoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = byte_pairs.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = st.sampled_from(["a", "b", " ", "\n", "the", "'s", "é", "日", "👍", "1", "  ", "\t", "!!", "ing", " th", " "])


@settings(max_examples=150, deadline=None)
@given(st.lists(PARTS, max_size=40).map("".join))
def test_encoding_matches_the_library(text):
    own = byte_pairs.encoder(RANKS, public_tokenizers.PATTERN)
    ranks = byte_pairs.read_ranks(RANKS) if not hasattr(test_encoding_matches_the_library, "lib") else None
    if ranks:
        test_encoding_matches_the_library.lib = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    ids = own.encode(text)
    assert ids == test_encoding_matches_the_library.lib.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_tables_of_last_tokens_follow_edits(own):
    rng = random.Random(4)
    for _ in range(150):
        data = bytes(rng.choices(b"abthe ing\n", k=rng.randrange(1, 400)))
        last = own.last_tokens(data)
        assert own.decode(own.read_back(last)) == data
        start = rng.randrange(len(data) + 1)
        stop, new = min(len(data), start + rng.randrange(9)), bytes(rng.choices(b"abthe", k=rng.randrange(5)))
        edited, table = own.replace(data, last, start, stop, new)
        assert (edited, table) == (data[:start] + new + data[stop:], own.last_tokens(edited))
        longer, table = own.append(edited, list(table), b"the")
        assert table == own.last_tokens(longer)


def test_editable_text_equals_encoding_anew(own):
    rng = random.Random(5)
    for _ in range(100):
        text = byte_pairs.EditableText(own, "".join(rng.choices("ab 'st\n é", k=30)))
        for _ in range(4):
            start = rng.randrange(len(text.text) + 1)
            stop, new = min(len(text.text), start + rng.randrange(4)), "".join(rng.choices("a \n's", k=rng.randrange(4)))
            want = text.text[:start] + new + text.text[stop:]
            text.replace(start, stop, new)
            assert text.text == want and text.ids() == own.encode(want)


def test_round_trip_of_edge_texts(make_docs, no_docs, edge_texts, library):
    docs = make_docs([*enumerate(edge_texts), (None, "one"), (4, "one")], clash=True)
    made = byte_pairs.round_trip_digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for key, text in [*enumerate(edge_texts), (None, "one"), (4, "one")]:
        ids = library.encode_ordinary(text or "")
        told = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((key, len(ids), told, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, made), key=repr) == sorted(want, key=repr)
    encoded = byte_pairs.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    decoded = byte_pairs.decode_ids(encoded, RANKS, public_tokenizers.PATTERN)
    assert sorted(bytes(row.decoded) for row in decoded.collect()) == sorted(
        (row.text or "").encode() for row in docs.collect()
    )
    assert byte_pairs.round_trip_digests(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_word_tokens_match_the_library():
    own, rng = token_files.WordTokenizer(WORD_BPE), random.Random(6)
    parts = ["a", "B", " ", "\n", "The", "'s", "é", "é", "Σ", "İ", "\t", "&.", "!!", "|", "<|endoftext|>", "1", "x" * 60, "."]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        want = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), own.kind).tolist() == want


def test_token_files_hold_all_documents_in_order(spark, make_docs, no_docs, edge_texts, tmp_path):
    rows = [*enumerate(edge_texts), (None, "one"), (4, "one")]
    place = str(tmp_path / "tokens")
    token_files.write_sequences(make_docs(rows, clash=True).repartition(5), place, WORD_BPE, end_id=2, length=7, batch=3)
    library = Tokenizer.from_file(WORD_BPE)
    ids = [
        (key, [*library.encode(text or "", add_special_tokens=False).ids, 2])
        for key, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    ]
    start, want = 0, []
    for key, one in ids:
        want.append((key, start, len(one), zlib.crc32(np.array(one, "<u4").tobytes())))
        start += len(one)
    made = token_files.document_checksums(spark, place).collect()
    assert sorted(map(tuple, made), key=lambda row: row[1]) == want
    whole = []
    for part in token_files.read_index(spark, place).select("part", "file").distinct().orderBy("part").collect():
        opened = token_files.SequenceFile(f"file://{place}/sequences/{part.file}")
        counts = [opened.reader.get_batch(n).num_rows for n in range(opened.reader.num_record_batches)]
        for number in range(sum(counts)):
            values, mask = opened.sequence(number)
            assert len(values) == len(mask) == 7
            whole += values[mask].tolist()
    assert whole == [one for _, document in ids for one in document]
    empty = str(tmp_path / "none")
    token_files.write_sequences(no_docs, empty, WORD_BPE, end_id=2)
    assert token_files.document_checksums(spark, empty).count() == 0


def test_quality_counts(spark, folder, make_docs, no_docs, edge_texts):
    docs = make_docs([*enumerate(edge_texts), (None, None), (4, "one")], clash=True)
    for row in quality_rules.clean_lines(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        if row.doc_id != 4:
            assert tuple(row)[1:7] == brute.base_counts(row.text), row.doc_id
    assert quality_rules.clean_lines(docs).count() == docs.count()
    assert quality_rules.clean_lines(no_docs).count() == 0
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in QUERIES["op9_quality_rules"](spark, folder).collect():
        assert tuple(row)[1:7] == brute.base_counts(texts[row.doc_id])


def test_quality_line_rules():
    lines = {
        "Home | News | About us | Contact": True,
        "WIN!! CASH!! NOW!! CLICK!! FAST!!": True,
        "THIS LINE SHOUTS AT ALL OF ITS READERS": True,
        "All rights reserved by the owners.": True,
        "*** $$$ ###": True,
        "A plain line, with a comma; and an end.": False,
        "Prices rose 3 % in 2020 (see table 4).": False,
        "": False,
    }
    _, _, failed = quality_rules.judge_lines("\n".join(lines))
    assert failed.tolist() == list(lines.values())


def test_quality_verdicts_follow_the_labels(spark, folder):
    judged = QUERIES["op9_quality_rules"](spark, folder.replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/labels.parquet")
    rows = judged.join(labels, "doc_id").where("not base_failed").collect()
    assert sum(row.kept == bool(row.quality) for row in rows) >= 0.98 * len(rows)


def counts(texts, languages):
    found = {}
    for name, text in zip(languages, texts, strict=True):
        for word in language_id.WORD.findall(text.lower()):
            for gram in language_id.grams(word):
                found[gram, name] = found.get((gram, name), 0) + 1
    return [(gram, name, n) for (gram, name), n in found.items()]


@pytest.fixture(scope="module")
def model():
    texts = ["the cat and the dog went there with them", "der hund und die katze sind nicht da", "кот и собака там"]
    return language_id.model_of(["en", "de", "ru"], counts(texts, ["en", "de", "ru"]), 3.0)


def test_viterbi_finds_the_best_path(model):
    rng = random.Random(8)
    vocabulary = "the and dog with der und nicht katze кот там 日本 x".split()
    texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(7))] for _ in range(60)]

    def value(words, path):
        scores, _ = model.score_words(words)
        changes = sum(a != b for a, b in zip(path, path[1:], strict=False))
        return sum(scores[i, p] for i, p in enumerate(path)) - model.penalty * changes

    for words, (path, _) in zip(texts, model.label(texts), strict=True):
        assert len(path) == len(words)
        if words:
            paths = np.stack(np.meshgrid(*[range(3)] * len(words), indexing="ij"), -1).reshape(-1, len(words))
            best = max(value(words, one.tolist()) for one in paths)
            assert value(words, path.tolist()) == pytest.approx(best, abs=1e-3)


def test_scripts_narrow_and_spans_change(model):
    words = "the cat and the dog кот и собака там".split()
    path, letters = model.label([words])[0]
    assert [model.languages[one] for one in path] == ["en"] * 5 + ["ru"] * 4
    assert letters.tolist() == list(map(len, words))
    _, neutral = model.score_words(["日本", "the"])
    assert neutral.tolist() == [True, False]


def test_languages_of_edge_texts(spark, make_docs, no_docs, edge_texts, model):
    docs = make_docs([*enumerate(edge_texts), (None, "one"), (4, "one")])
    rows = language_id.label_languages(docs, model, keep=("doc_id", "text")).collect()
    assert len(rows) == docs.count()
    for row in rows:
        letters = any(char.isalpha() for char in row.text or "")
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
        assert row.lang_pred in ("und", *model.languages)
    nothing = language_id.learn(no_docs)
    assert {row.lang_pred for row in language_id.label_languages(docs, nothing).collect()} == {"und"}
    assert language_id.label_languages(no_docs, model).count() == 0


def test_held_out_accuracy(spark, folder):
    place = folder.replace("0.001", "0.01")
    langs = spark.read.parquet(f"{place}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op8_language_id"](spark, place).join(langs, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(row.doc_id).encode()) % 4 == 2 for row in rows)
    assert sum(row.lang_pred == row.lang for row in rows) >= 0.98 * len(rows)


ARTICLE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h2>Site name that is rather long for a header</h2></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">A menu entry with many words in it</a></ul></nav>
<div class="cookie-notice">We use cookies on this page, and we tell you so at length.</div>
<div id="wrap"><article><header><h1>Head &amp; line</h1></header><div class="post-content"><p>First   paragraph
with <b>bold</b> and <a href="#">a link</a>, &eacute; &#8212; 1 &lt; 2.<br>Next line<p>Hm.</div>
<aside>Related stories and more of them</aside><form><label>Mail</label><input></form>
<blockquote>Quoted words of some length, said by somebody.</blockquote></article>
<section class="comments"><p>A reader's comment that is long enough to look like a paragraph.</p></section></div>
<div class="sidebar">Other things to read, with a good number of words</div><!-- <p>no</p> -->
<footer>&copy; Somebody</footer></body></html>"""


def test_article_without_its_surroundings():
    assert html_extract.main_lines(ARTICLE) == [
        "Head & line",
        "First paragraph with bold and a link, é — 1 < 2. Next line",
        "Hm.",
        "Quoted words of some length, said by somebody.",
    ]
    plain = "<div><p>" + "Words of a text. " * 20 + "</p><p>Short.</p></div>"
    assert html_extract.main_lines(plain)[1:] == ["Short."]
    for odd in ("", "<", "<p", "</div></div>", "<nav>only a menu</nav>", "<p>" * 3000):
        assert html_extract.main_lines(odd) in ([], ["<"], ["<p"])


def test_pages(spark, folder):
    pages = spark.createDataFrame(
        [(1, "u", ARTICLE), (2, None, None), (None, "v", ""), (1, "u", ARTICLE)], "page_id long, url string, html string"
    ).selectExpr("*", "1 AS text", "2 AS n_chars")
    rows = html_extract.extract_pages(pages).collect()
    assert sorted((row.page_id or 0, row.n_chars) for row in rows) == sorted(
        [(1, len("\n\n".join(html_extract.main_lines(ARTICLE))))] * 2 + [(2, 0), (0, 0)]
    )
    assert html_extract.extract_pages(pages.limit(0)).count() == 0
    for row in QUERIES["op5_html_extract"](spark, folder).collect():
        assert row.n_chars == len(row.text) and "track(" not in row.text and "©" not in row.text
