"""Line-first cleaning: rules judge every line, failing lines go, and documents that lose too much are rejected.

Every line (``\\n``-split) with a word is judged by itself:

* marks: over ``max_marks`` of its characters are neither letters nor digits, or it has no letter;
* shouting: at least ten letters, over ``max_upper`` of them upper case;
* navigation: it holds separator words (``|`` and the like), one for every three other words or more;
* boilerplate: it names one of ``PHRASES``.

Null and empty texts have no words and no lines; all counts are 0 and they fail the base rules. Repeated rows are judged
each by itself. Whole texts are read, whatever their length.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from clearlot.llm.common import id_field, in_python, schema_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
SEPARATORS = "|•·»›>"
PHRASES = (
    "all rights reserved",
    "licensed under",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "enable javascript",
    "click here",
    "subscribe to our",
    "sign up for",
)
MAX_MARKS = 0.2
MAX_UPPER = 0.6
#: A document that loses more than this share of its word characters is rejected.
MAX_LOST = 0.3

_SPACE, _LETTER, _UPPER, _DIGIT, _SEPARATOR = 1, 2, 4, 8, 16


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """For every code point the kinds of character it counts as."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] == "L":
            table[code] = _LETTER | (_UPPER if kind == "Lu" else 0)
        elif kind[0] == "N":
            table[code] = _DIGIT
    table[[ord(c) for c in SPACES]] = _SPACE
    table[[ord(c) for c in SEPARATORS]] |= _SEPARATOR
    return table


def count_repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) > 2_000_000:  # keeps the product of three numbers below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    keys = pairs[:-1] * len(numbers) + ids[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift : shift + len(keys)] |= again
    return int(hit.sum())


def judge_lines(
    text: str, max_marks: float = MAX_MARKS, max_upper: float = MAX_UPPER
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The lines, the word characters of each, and which of them fail a rule (lines without a word never do)."""
    lines = text.split("\n")
    kinds = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum([len(line) + 1 for line in lines]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[ends] - total[starts]

    space = (kinds & _SPACE) > 0
    before = np.concatenate([[True], space[:-1]])
    after = np.concatenate([space[1:], [True]]) if len(space) else space
    letters = per_line((kinds & _LETTER) > 0)
    chars = per_line(~space)
    words = per_line(~space & before)
    bars = per_line(((kinds & _SEPARATOR) > 0) & before & after)
    marks = chars - letters - per_line((kinds & _DIGIT) > 0)
    upper = per_line((kinds & _UPPER) > 0)
    failed = (letters == 0) | (marks > max_marks * chars)
    failed |= (letters >= 10) & (upper > max_upper * letters)
    failed |= (bars > 0) & (3 * bars >= words - bars)
    lower = text.lower()
    if any(phrase in lower for phrase in PHRASES):
        failed |= np.array([any(phrase in line.lower() for phrase in PHRASES) for line in lines])
    return lines, chars, failed & (chars > 0)


def clean_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_lost: float = MAX_LOST,
    max_marks: float = MAX_MARKS,
    max_upper: float = MAX_UPPER,
) -> DataFrame:
    """Counts, verdict and the remaining text of every document; other columns of ``docs`` are left out."""
    schema = schema_of(
        id_field(docs, id_column),
        "n_words long", "word_chars long", "n_symbols long", "n_dup_lines long", "n_repeat_words long",
        "base_failed boolean", "kept boolean", "n_lines long", "n_failed_lines long", "lost_chars long",
        "clean_text string",
    )

    def start():
        _classes()

        def row(key, text) -> tuple:
            text = text or ""
            words = text.encode("utf-8", "surrogatepass").split()
            lines, chars, failed = judge_lines(text, max_marks, max_upper)
            with_words = [line for line, n in zip(lines, chars, strict=True) if n]
            repeated = count_repeated(words)
            total, lost = int(chars.sum()), int(chars[failed].sum())
            base_failed = len(words) < 50 or 100 * repeated > 50 * len(words)
            return (
                key,
                len(words),
                total,
                sum(map(text.count, SYMBOLS)),
                len(with_words) - len(set(with_words)),
                repeated,
                base_failed,
                not base_failed and lost <= max_lost * total,
                len(with_words),
                int(failed.sum()),
                lost,
                "\n".join(line for line, bad in zip(lines, failed, strict=True) if not bad),
            )

        return row

    return in_python(docs.select(id_column, text_column), schema, start, measure=1)
