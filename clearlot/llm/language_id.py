"""Language spans of mixed-language texts.

A model holds, for every language it has seen, the log probabilities of letter n-grams inside words, and the scripts that
the language is written in. A word's candidates are the languages that use its script (``SCRIPTS``: ranges of code
points); each candidate gets the sum of its n-gram scores. Over the words of a text the Viterbi path is the labelling
with the highest sum of word scores minus a penalty for each change of language; its runs are the spans. The text's
language is the one that labels the most letters, and the score is that share of all letters.

Words are runs of letters and combining marks, lower-cased, that hold a letter. A word in a script that no language uses is neutral: it
takes the language of its neighbours and counts for none. Null texts, and texts without a letter, are ``und`` with score
0 and no spans; so is every text if nothing was learned. A text with neutral words only gets the most frequent language
with score 0. Ties go to the language with more training documents, then the lesser name. Repeated rows are labelled each
by itself.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearlot.llm.common import schema_of, text_or_empty, then_given_back

#: First code points of script ranges (Unicode blocks) and the script from there on; "" is none.
SCRIPTS = (
    (0x0041, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0780, ""),
    (0x0900, "Devanagari"),
    (0x0980, "Indic"),
    (0x0E00, "Thai"),
    (0x0E80, ""),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x13A0, ""),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, ""),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xAC00, "Hangul"),
    (0xD7B0, ""),
    (0xF900, "Han"),
    (0xFB00, "Latin"),
    (0xFB13, ""),
    (0x20000, "Han"),
    (0x32000, ""),
)
_STARTS = [start for start, _ in SCRIPTS]

#: Training documents of each language (on average, where there are more), and the most n-grams that the model keeps.
DOCS_PER_LANGUAGE = 2_000
HASH_RANGE = 1 << 40
MAX_GRAMS = 200_000
LONGEST_GRAM = 4
#: What a change of language costs, in units of the natural logarithm.
SWITCH_PENALTY = 12.0
#: A language uses a script that holds at least this share of its letters.
MIN_SCRIPT_SHARE = 0.01
#: Smoothing count of n-grams a language has not shown.
SMOOTHING = 0.5
#: Words labelled together; a task holds their scores.
WORDS_AT_ONCE = 400_000
TABLE_SIZE = 500_000
LONG = 40
UNDETERMINED = "und"

WORD = regex.compile(r"[\p{L}\p{M}]+")


def words_of(text: str | None) -> list[str]:
    """The lower-cased words; marks without any letter are none."""
    found = WORD.findall((text or "").lower())
    return [word for word in found if word[0].isalpha() or any(map(str.isalpha, word))]


def script_of(char: str) -> str:
    at = bisect_right(_STARTS, ord(char)) - 1
    return SCRIPTS[at][1] if at >= 0 else ""


def grams(word: str) -> list[str]:
    """The n-grams of a word with marks at its ends."""
    marked = f"^{word}$"
    return [marked[i : i + n] for n in range(1, LONGEST_GRAM + 1) for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    languages: list[str]
    #: n-gram -> its row of ``scores``; row 0 is that of n-grams nobody has shown
    rows: dict[str, int]
    #: a score for each n-gram and language
    scores: np.ndarray
    #: script -> which languages use it
    users: dict[str, np.ndarray]
    penalty: float = SWITCH_PENALTY

    def __post_init__(self) -> None:
        self._forget(0)

    def _forget(self, size: int) -> None:
        self._known: dict[str, int] = {}
        self._table = np.zeros((size, len(self.languages)), np.float32)
        self._letters = np.zeros(size, np.int64)

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A score for each word and language, and which words are neutral."""
        found: list[int] = []
        starts = []
        get = self.rows.get
        for word in words:
            starts.append(len(found))
            found += [get(gram, 0) for gram in grams(word)]
        totals = np.add.reduceat(self.scores[found], starts, axis=0)
        scripts = [script_of(word[0]) for word in words]
        neutral = np.array([script not in self.users for script in scripts])
        everyone = np.ones(len(self.languages), bool)
        users = np.array([self.users.get(script, everyone) for script in scripts])
        least = totals.min(1, keepdims=True) - 4 * self.penalty
        return np.where(neutral[:, None], 0, np.where(users, totals, least)), neutral

    def _numbers(self, words: list[str]) -> np.ndarray:
        """A row of the table of scores for each word."""
        known = self._known
        new = [word for word in dict.fromkeys(words) if word not in known]
        if len(known) + len(new) > len(self._table):
            new = list(dict.fromkeys(words))
            self._forget(max(TABLE_SIZE, len(new)))
            known = self._known
        if new:
            at = len(known)
            scores, neutral = self.score_words(new)
            self._table[at : at + len(new)] = scores
            self._letters[at : at + len(new)] = np.where(neutral, 0, list(map(len, new)))
            known.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def label(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The Viterbi path of every list of words, and the letters that each word counts for.

        All lists advance together, word by word.
        """
        lengths = np.array([len(words) for words in texts], np.int64)
        if not lengths.sum():
            return [(np.zeros(0, np.int8), np.zeros(0, np.int64)) for _ in texts]
        numbers = self._numbers([word for words in texts for word in words])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        first, counts, longest = starts[order], lengths[order], int(lengths.max())
        active = len(counts) - np.searchsorted(counts[::-1], np.arange(longest), side="right")
        base = np.concatenate([[0], np.cumsum(active)])
        came = np.zeros((int(base[-1]), len(self.languages)), np.int8)
        own = np.arange(len(self.languages), dtype=np.int8)
        lines = np.arange(len(order))
        best = self._table[numbers[first]].astype(np.float64)
        ends = np.zeros(len(order), np.int8)
        for at in range(1, longest):
            n = active[at]
            if n < len(best):
                ends[n : len(best)] = best[n:].argmax(1)
                best = best[:n]
            top = best.argmax(1)
            changed = best[lines[:n], top] - self.penalty
            stays = best >= changed[:, None]
            came[base[at] : base[at + 1]] = np.where(stays, own, top[:, None])
            best = np.where(stays, best, changed[:, None]) + self._table[numbers[first[:n] + at]]
        ends[: len(best)] = best.argmax(1)
        flat = np.zeros(int(base[-1]), np.int8)
        state = ends
        for at in range(longest - 1, -1, -1):
            n = active[at]
            flat[base[at] : base[at] + n] = state[:n]
            if at:
                state[:n] = came[base[at] + lines[:n], state[:n]]
        paths = [np.zeros(0, np.int8)] * len(texts)
        for rank, text in enumerate(order):
            paths[text] = flat[base[: counts[rank]] + rank]
        letters = self._letters[numbers]
        return [(path, letters[a : a + n]) for path, a, n in zip(paths, starts, lengths, strict=True)]


def usable(lang: str = "lang") -> Column:
    return F.col(lang).isNotNull() & (F.col(lang) != UNDETERMINED)


def learn(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    max_grams: int = MAX_GRAMS,
    penalty: float = SWITCH_PENALTY,
) -> LanguageModel:
    """A model from labelled documents; rows without a language or an id are left out.

    All rows are counted. The n-grams come from ``docs_per_language`` documents of each language, or all if there are
    fewer, chosen by the hash of their ids; the driver gets ``max_grams`` of them, the most frequent of each language in turn.
    """
    labelled = docs.where(usable(lang_column) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(lang_column).alias("lang"), text_or_empty(text_column).alias("text")
    )
    sizes = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes, key=lambda name: (-sizes[name], name))
    # a row is read if the hash of its id lies below its language's share of the range
    shares = [(name, int(HASH_RANGE * min(1.0, docs_per_language / size))) for name, size in sizes.items()]
    chosen = docs.sparkSession.createDataFrame(shares, "lang string, below long")
    words = (
        labelled.join(F.broadcast(chosen), "lang")
        .where(F.pmod(F.xxhash64("id"), F.lit(HASH_RANGE)) < F.col("below"))
        .select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{M}]+)"), 1)).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    def of_size(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("marked") - (size - 1))
        found = F.transform(starts, lambda i: F.substring(F.col("marked"), i, F.lit(size)))
        return F.when(F.length("marked") >= size, found).otherwise(F.array().cast("array<string>"))

    pieces = F.concat(*[of_size(size) for size in range(1, LONGEST_GRAM + 1)])
    counted = (
        words.select("lang", "n", marked.alias("marked"))
        .select("lang", "n", F.explode(pieces).alias("gram"))
        .groupBy("gram", "lang")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
        .orderBy("rank", "lang")
        .limit(max_grams)
        .collect()
    )
    return model_of(languages, [(row["gram"], row["lang"], row["n"]) for row in counted], penalty)


def model_of(languages: list[str], counted: list[tuple[str, str, int]], penalty: float) -> LanguageModel:
    """The model of n-gram counts; n-grams of a size share one total for each language."""
    at = {name: number for number, name in enumerate(languages)}
    table: dict[str, np.ndarray] = {}
    totals = np.zeros((LONGEST_GRAM + 1, len(languages)))
    scripts: dict[str, np.ndarray] = {}
    for gram, name, n in counted:
        table.setdefault(gram, np.zeros(len(languages)))[at[name]] += n
        totals[len(gram), at[name]] += n
        if len(gram) == 1 and gram not in "^$":
            scripts.setdefault(script_of(gram), np.zeros(len(languages)))[at[name]] += n
    kinds = np.bincount([len(gram) for gram in table], minlength=LONGEST_GRAM + 1) + 1
    weight = 1 / LONGEST_GRAM
    rows = {gram: number for number, gram in enumerate(table, 1)}
    scores = np.zeros((len(table) + 1, len(languages)))
    for gram, row in table.items():
        share = (row + SMOOTHING) / (totals[len(gram)] + SMOOTHING * kinds[len(gram)])
        scores[rows[gram]] = weight * np.log(share)
    letters = np.maximum(sum(scripts.values(), np.zeros(len(languages))), 1)
    users = {name: row >= MIN_SCRIPT_SHARE * letters for name, row in scripts.items() if name}
    return LanguageModel(languages, rows, scores, {name: row for name, row in users.items() if row.any()}, penalty)


def label_languages(
    docs: DataFrame, model: LanguageModel, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``lang_pred``, ``score`` and ``spans`` (language, first word, words) beside the columns ``keep`` of every document."""
    kept = [docs.schema[name] for name in keep]
    own = schema_of(
        "lang_pred string", "score double", "spans array<struct<lang: string, first_word: int, n_words: int>>"
    )
    schema = T.StructType(kept + own.fields)
    learned = (model.languages, model.rows, model.scores, model.users, model.penalty)
    shared = docs.sparkSession.sparkContext.broadcast(learned)  # bounded by max_grams

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, own = to_arrow_schema(schema), LanguageModel(*shared.value)
        names = own.languages

        def result(words: list[str], path: np.ndarray, letters: np.ndarray) -> tuple:
            if not words:
                return UNDETERMINED, 0.0, []
            held = np.bincount(path, weights=letters, minlength=len(names))
            top = int(held.argmax())
            starts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1])
            sizes = np.diff(np.concatenate([starts, [len(path)]]))
            spans = [
                {"lang": names[path[a]], "first_word": int(a), "n_words": int(n)}
                for a, n in zip(starts, sizes, strict=True)
            ]
            return names[top], float(held[top] / sum(map(len, words))), spans

        def labelled(rows: pa.RecordBatch, texts: list[list[str]]) -> pa.RecordBatch:
            if names:
                made = [result(words, *one) for words, one in zip(texts, own.label(texts), strict=True)]
            else:
                made = [(UNDETERMINED, 0.0, [])] * len(texts)
            new = [pa.array(list(v), f.type) for v, f in zip(zip(*made, strict=True), list(arrow)[len(kept) :], strict=True)]
            old = [rows.column(name).cast(f.type) for name, f in zip(keep, arrow, strict=False)]
            return pa.RecordBatch.from_arrays([*old, *new], schema=arrow)

        for batch in batches:
            texts, held, first = [], 0, 0
            for at, text in enumerate(batch.column(text_column)):
                texts.append(words_of(text.as_py()))
                held += len(texts[-1])
                if held >= WORDS_AT_ONCE or at + 1 == batch.num_rows:
                    yield labelled(batch.slice(first, at + 1 - first), texts)
                    texts, held, first = [], 0, at + 1

    # the text goes along once, also if it is kept
    return docs.select(*dict.fromkeys([text_column, *keep])).mapInArrow(
        lambda batches: then_given_back(task(batches)), schema
    )


def held_out(id_column: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row belongs to the fold that is never learned from; false without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
