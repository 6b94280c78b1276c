"""op8: marks without letters are no words, and a bound on n-grams is shared among the languages."""

from __future__ import annotations

from clearlot.llm import language_id


def test_marks_alone_are_undetermined(make_docs):
    model = language_id.model_of(["en"], [(gram, "en", 5) for gram in ("^", "$", "a", "b", "ab")], 12.0)
    rows = [(1, "́̂ ́"), (2, "ab ́"), (3, "́ab"), (4, None)]
    made = {row["doc_id"]: row for row in language_id.label_languages(make_docs(rows), model).collect()}
    assert (made[1]["lang_pred"], made[1]["score"], made[1]["spans"]) == ("und", 0.0, [])
    assert (made[2]["lang_pred"], made[2]["score"], made[2]["spans"][0]["n_words"]) == ("en", 1.0, 1)
    assert made[3]["lang_pred"] == "en" and made[4]["lang_pred"] == "und"


def test_small_languages_keep_their_grams(spark):
    rows = [(key, "the quick brown fox jumps over the lazy dog " * 20, "en") for key in range(50)]
    rows.append((99, "zwölf boxkämpfer jagen viktor quer über den deich", "de"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs, max_grams=100)
    assert any("ö" in gram for gram in model.rows)  # none is among the hundred most frequent of all
    held = language_id.learn(docs, max_grams=100_000)
    assert set(model.rows) < set(held.rows)
