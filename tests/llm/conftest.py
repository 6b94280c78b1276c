import random

import pytest
from pyspark.sql import types as T

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ["id", "digest", "class", "key", "root", "removed", "spans", "first", "words", "part", "item", "ids"]


@pytest.fixture(scope="session")
def sentences():
    """Lines of invented words, all different."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(9, 16))).capitalize() + "." for _ in range(400)]


@pytest.fixture(scope="session")
def edge_texts(sentences):
    """Empty, odd, long and repeated texts; near copies; texts that share passages."""
    s = sentences
    long_text = "\n".join(s[:60] * 30)
    body = s[100] + "\n" + s[101] + "\n" + s[102] + " " + s[103]
    return [
        None, "", " ", "\n\n", "one", "Two words", "two WORDS", "a\x00b c\x00d", "...", "ÀÉ ñ ß 日本 👍 é", s[0],
        s[0], s[0] + "\n" + s[1], body, body.replace(s[100].split()[3], "zzz", 1), body.upper(), body + " tail",
        s[5] + "\n" + s[5][:-1] + "!\n" + s[6], "x " + s[6] + s[7], "same " * 300, "same " * 301, long_text,
        long_text + "\n" + s[200], "\t" + s[8] + "\r\n" + s[9], "a" * 3000, " ".join(s[20:26]), " ".join(s[22:28]),
        "z" * 49, "z" * 50, "z" * 51,
    ]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (id, text) pairs; ``clash`` adds columns named like those that operators make."""

    def make(rows, clash=False):
        frame = [(key, text, "en" if at % 3 else None, None, None) for at, (key, text) in enumerate(rows)]
        docs = spark.createDataFrame(frame, FIELDS)
        if clash:
            for name in CLASHES:
                docs = docs.selectExpr("*", f"array(1) AS {name}")
        return docs

    return make


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T.StructType.fromDDL(FIELDS))
