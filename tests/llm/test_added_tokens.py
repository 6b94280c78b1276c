"""Added tokens are matched as they are written."""

import random
import zlib

import numpy as np
import public_tokenizers

from clearlot.llm import token_files

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LIKE = ["<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|StartOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>"]


def test_words_like_added_tokens_match_the_library():
    own, rng = token_files.WordTokenizer(WORD_BPE), random.Random(8)
    assert np.frombuffer(own.encode("<|ENDOFTEXT|>"), own.kind).tolist() == [27, 347, 40786, 4160, 91, 285]
    parts = [*LIKE, "a", "B", "The", "É", " ", "\n", ".", "!!", "|", "<|", "|>"]
    for _ in range(600):
        text = "".join(rng.choices(parts, k=rng.randrange(9)))
        want = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), own.kind).tolist() == want, text


def test_documents_with_words_like_added_tokens(spark, make_docs, tmp_path):
    rows = [(n, f"Before {word} after") for n, word in enumerate(LIKE)]
    place = str(tmp_path / "tokens")
    token_files.write_sequences(make_docs(rows), place, WORD_BPE, end_id=2)
    library, start, want = token_files.WordTokenizer(WORD_BPE).tokenizer, 0, []
    for key, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.document_checksums(spark, place).collect())) == want


def test_parts_are_encoded_as_if_alone():
    """Whatever stands beside it, a part gets the ids that the library gives to it alone."""
    tokenizer = token_files.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    parts = ["a", "Ünï", "x\ty", "<", "<|", "|>", "<|endoftext|", "endoftext|>", "\u200b", "\x00", "日本", "👍🏽", "'s", "12a3", "e\u0301", "\r", "ß" * 60]
    alone = [tokenizer._packed(tokenizer.tokenizer.encode(part, add_special_tokens=False).ids) for part in parts]
    assert tokenizer._encoded(parts) == alone
    more = [*parts, "<|endoftext|>", "<|EndOfText|>x"]
    alone = [tokenizer._packed(tokenizer.tokenizer.encode(part, add_special_tokens=False).ids) for part in more]
    assert tokenizer._encoded(more) == alone
    assert tokenizer._encoded(["one"]) == [tokenizer.encode("one")]


def test_known_words_are_looked_up_once(monkeypatch):
    """A text with a new word among many known ones is not looked up a second time as a whole."""
    own = token_files.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    text = " ".join(["some", "known", "words"] * 100)
    first = own.encode(text)
    seen = []

    class Counting(token_files._Table):
        def __getitem__(self, word):
            seen.append(word)
            return self.get(word) or self.__missing__(word)

    counting = Counting()
    counting.update(own._words)
    own._words = counting
    both = own.encode_all([text + " unheard", text, "unheard " + text])
    assert len(seen) == 301 + 300 + 301
    new = token_files.WordTokenizer(public_tokenizers.path("word_bpe_49k.json")).encode("unheard")
    assert both == [first + new, first, new + first]
