"""Lines of every length are compared."""

from clearlot.llm import line_dedup
from clearlot.llm.queries import QUERIES
from tests.llm import brute


def test_short_lines_that_repeat_are_removed(make_docs):
    rows = [(1, "Menu\n\n a \nMenu\t\n" + "y" * 19), (2, " \nmenu\na\n" + "y" * 18 + "z\n" + "y" * 19), (3, "\n\n")]
    made = {row.doc_id: (row.text, row.removed) for row in line_dedup.without_repeated_lines(make_docs(rows)).collect()}
    assert made == {
        1: ("Menu\n\n a \n" + "y" * 19, [3]),
        2: (" \nmenu\n" + "y" * 18 + "z", [2, 4]),
        3: ("\n\n", None),
    }


def test_lines_of_all_lengths_match_brute_force(spark, folder):
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = brute.repeated_lines(docs)
    lines = {key: (text or "").split("\n") for key, text in docs}
    assert any(len(lines[key][at].strip()) < line_dedup.MIN_CHARS for key, numbers in want.items() for at in numbers)
    made = QUERIES["op10_line_dedup"](spark, folder).collect()
    assert {row.doc_id: row.removed for row in made if row.removed} == want
