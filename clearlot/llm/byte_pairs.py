"""Byte-level BPE by dynamic programming over prefixes.

The encoding of a byte string fixes the encodings of all its prefixes: for every prefix there is exactly one token that
can end it. A token of length n ends the prefix of length i if it is compatible with the token that ends the prefix of
length i - n, and two tokens are compatible if merging their bytes gives just these two again. So a table of last tokens,
one for each prefix, is enough to read the encoding back from the end, to append bytes without looking at what stands
before, and to encode again near an edit only.

Null texts are empty texts; an empty text has no tokens. Repeated rows are encoded each by itself.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from clearlot.llm.common import id_field, in_python, schema_of

#: Entries of each table that a task keeps; a full table is emptied.
TABLE_SIZE = 500_000
#: Longer words, pieces and prefixes are not remembered.
LONG = 48
_SHORT_SIZES = (2, 1)


class PrefixEncoder:
    """Tokens of byte strings and texts by the ranks of a vocabulary that holds every single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: data for data, rank in ranks.items()}
        self.digits = {rank: str(rank) for rank in self.bytes_of}
        self.longest = max(map(len, ranks))
        sizes: dict[bytes, set[int]] = {}
        for data in ranks:
            if len(data) > 2:
                sizes.setdefault(data[-3:], set(_SHORT_SIZES)).add(len(data))
        #: The lengths of tokens by their last three bytes, long ones first.
        self._sizes = {end: tuple(sorted(found, reverse=True)) for end, found in sizes.items()}
        self.split = regex.compile(pattern)
        self._whole: dict[int, bool] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._prefixes: dict[bytes, int] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._words: dict[str, tuple[int, ...] | None] = {}

    # ------------------------------------------------------------ last tokens of prefixes

    def _merges_to(self, data: bytes, border: int) -> bool:
        """Whether plain merging of the bytes of one or two tokens gives just these, with ``border`` between two."""
        get, none = self.ranks.get, len(self.ranks)
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        left = border  # parts before the border
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            if i + 1 == left:
                return False
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < left:
                left -= 1
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
        return len(parts) == 1 + (border > 0)

    def _stands(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self._merges_to(self.bytes_of[token], 0)
        return known

    def _follows(self, token: int, last: int) -> bool:
        """Whether ``token`` may come after ``last``."""
        known = self._fits.get((last, token))
        if known is None:
            if len(self._fits) >= TABLE_SIZE:
                self._fits.clear()
            first = self.bytes_of[last]
            known = self._fits[last, token] = self._merges_to(first + self.bytes_of[token], len(first))
        return known

    def last_tokens(self, data: bytes, known: list[int] | None = None, stop: int | None = None) -> list[int]:
        """The last token of every prefix of ``data``, at 0 a placeholder; ``known`` are those of the first prefixes."""
        last = known if known is not None else [-1]
        ranks, longest = self.ranks, self.longest
        for end in range(len(last), (len(data) if stop is None else stop) + 1):
            for size in range(min(end, longest), 0, -1):
                token = ranks.get(data[end - size : end])
                if token is not None and (
                    self._stands(token) if size == end else self._follows(token, last[end - size])
                ):
                    last.append(token)
                    break
        return last

    def read_back(self, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens stands for."""
        ids, at = [], len(last) - 1
        while at:
            ids.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return ids[::-1]

    def append(self, data: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """``data`` with ``more`` after it; only the new prefixes are worked out."""
        data += more
        return data, self.last_tokens(data, last)

    def replace(self, data: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """``data`` with ``new`` in place of ``data[start:stop]``.

        Prefixes before the edit keep their tokens. After it, prefixes are worked out until as many as the longest token
        has bytes agree with the old table in a row: from there on both tables are made from the same values.
        """
        edited = data[:start] + new + data[stop:]
        shift = len(new) - (stop - start)
        table, agreed = last[: start + 1], 0
        for end in range(start + 1, len(edited) + 1):
            self.last_tokens(edited, table, end)
            old = end - shift
            same = end > start + len(new) and old > stop and len(self.bytes_of[table[end]]) <= old
            agreed = agreed + 1 if same and last[old] == table[end] else 0
            if agreed >= self.longest:
                return edited, table + last[old + 1 :]
        return edited, table

    # ------------------------------------------------------------ pieces and texts

    def _last_token(self, data: bytes) -> int:
        """The last token of one short prefix; the table of prefixes is shared by all pieces."""
        known, ranks, fits = self._prefixes, self.ranks, self._fits
        end = len(data)
        for size in self._sizes.get(data[-3:], _SHORT_SIZES):
            if size > end:
                continue
            token = ranks.get(data[end - size :])
            if token is None:
                continue
            if size == end:
                fit = self._stands(token)
            else:
                before = data[: end - size]
                last = known.get(before)
                if last is None:
                    last = self._last_token(before)
                fit = fits.get((last, token))
                if fit is None:
                    fit = self._follows(token, last)
            if fit:
                known[data] = token
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def _encode_short(self, data: bytes) -> tuple[int, ...]:
        """As ``read_back(last_tokens(data))``; only the prefixes that are asked for are worked out."""
        known, ids = self._prefixes, []
        if len(known) >= 2 * TABLE_SIZE:
            known.clear()
        while data:
            token = known.get(data)
            if token is None:
                token = self._last_token(data)
            ids.append(token)
            data = data[: -len(self.bytes_of[token])]
        return tuple(ids[::-1])

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """One match of the pattern; a piece that is a token is that token."""
        ids = self._pieces.get(piece)
        if ids is None:
            data = piece.encode("utf-8", "replace")
            whole = self.ranks.get(data)
            if whole is not None:
                ids = (whole,)
            elif len(data) > LONG:
                return tuple(self.read_back(self.last_tokens(data)))
            else:
                ids = self._encode_short(data)
            if len(self._pieces) >= TABLE_SIZE:
                self._pieces.clear()
            self._pieces[piece] = ids
        return ids

    def _encode_word(self, word: str) -> tuple[int, ...] | None:
        """A space and the word after it; None if white space at the word's ends could join that of its neighbours."""
        if not word or word[0].isspace() or word[-1].isspace():
            ids = None
        else:
            ids = tuple(chain.from_iterable(map(self.encode_piece, self.split.findall(" " + word))))
        if len(self._words) >= TABLE_SIZE:
            self._words.clear()
        if len(word) <= LONG:
            self._words[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """All tokens of a text.

        No match of the pattern goes on over a space between two characters that are no white space, so the parts
        between such spaces are encoded, and remembered, one by one.
        """
        words = text.split(" ")
        ids = list(chain.from_iterable(map(self.encode_piece, self.split.findall(words[0]))))
        if words[0][-1:].isspace() or (len(words) > 1 and not words[0]):
            return list(chain.from_iterable(map(self.encode_piece, self.split.findall(text))))
        known, unknown = self._words.get, self._encode_word
        for word in words[1:]:
            part = known(word) or unknown(word)
            if part is None:
                return list(chain.from_iterable(map(self.encode_piece, self.split.findall(text))))
            ids += part
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class EditableText:
    """A text with its tokens, piece by piece, that can be changed in place at a cost near the edit."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, text
        self.ends = [match.end() for match in encoder.split.finditer(text)]
        starts = [0, *self.ends[:-1]]
        self.tokens = [encoder.encode_piece(text[a:b]) for a, b in zip(starts, self.ends, strict=False)]

    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.tokens))

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Puts ``new`` in place of ``text[start:stop]``.

        A match depends on its own characters and on two after it, so pieces that end two characters or more before the
        edit stay. Splitting goes on from there until it meets an old border after the edit.
        """
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        kept = bisect_left(self.ends, start - 1)
        at = self.ends[kept - 1] if kept else 0
        ends, tokens = self.ends[:kept], self.tokens[:kept]
        old = bisect_left(self.ends, stop)
        while at < len(self.text):
            match = self.encoder.split.match(self.text, at)
            ends.append(match.end())
            tokens.append(self.encoder.encode_piece(match.group()))
            at = match.end()
            if at >= start + len(new):
                old = bisect_left(self.ends, at - shift, old)
                if old < len(self.ends) and self.ends[old] == at - shift:
                    ends += [end + shift for end in self.ends[old + 1 :]]
                    tokens += self.tokens[old + 1 :]
                    break
        self.ends, self.tokens = ends, tokens


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> PrefixEncoder:
    """One encoder for each Python worker."""
    return PrefixEncoder(read_ranks(path), pattern)


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document its token ids. ``ranks_path`` is a file that every executor has."""

    def start():
        own = encoder(ranks_path, pattern)

        def row(key, text) -> tuple:
            ids = own.encode(text or "")
            return key, ids, len(ids)

        return row

    schema = schema_of(id_field(docs, id_column), "ids array<int>", "n_tokens long")
    return in_python(docs.select(id_column, text_column), schema, start, measure=1)


def decode_ids(
    encoded: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", ids_column: str = "ids"
) -> DataFrame:
    """Per document the bytes that its token ids stand for."""

    def start():
        own = encoder(ranks_path, pattern)
        return lambda key, ids: (key, own.decode(ids or []))

    schema = schema_of(id_field(encoded, id_column), "decoded binary")
    return in_python(encoded.select(id_column, ids_column), schema, start, measure=1)


def round_trip_digests(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encodes and decodes every document and returns digests of the ids and of the decoded bytes.

    The same as ``decode_ids(encode_texts(...))`` with the digests taken in the task; ids leave it on demand only.
    """

    def start():
        own = encoder(ranks_path, pattern)
        sha256 = hashlib.sha256

        def row(key, text) -> tuple:
            ids = own.encode(text or "")
            told = sha256(" ".join(map(own.digits.__getitem__, ids)).encode()).hexdigest()
            return key, len(ids), told, sha256(own.decode(ids)).hexdigest(), *([ids] if with_ids else [])

        return row

    schema = schema_of(
        id_field(docs, id_column), "n_tokens long", "ids_sha256 string", "decoded_sha256 string",
        *["ids array<int>"] * with_ids,
    )
    return in_python(docs.select(id_column, text_column), schema, start, measure=1)
