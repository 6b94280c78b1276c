"""Plain versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

UPPER = {code: code + 32 for code in range(65, 91)}
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Union:
    """Components whose root is the least member."""

    def __init__(self, members):
        self.above = {one: one for one in members}

    def root(self, one):
        while self.above[one] != one:
            one = self.above[one]
        return one

    def link(self, a, b):
        low, high = sorted((self.root(a), self.root(b)))
        self.above[high] = low


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shingles(text, size):
    words = WORD.findall((text or "").translate(UPPER))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def similar(docs, alike, size):
    """(id, set size, component) of documents with distinct ids."""
    sets = {key: shingles(text, size) for key, text in docs}
    union = Union(sets)
    keys = sorted(sets)
    for at, one in enumerate(keys):
        for other in keys[:at]:
            common = len(sets[one] & sets[other])
            if common and alike[1] * common >= alike[0] * len(sets[one] | sets[other]):
                union.link(one, other)
    return sorted((key, len(sets[key]), union.root(key)) for key in keys)


def contamination(docs, items, window=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = BENCH_WORD.findall((text or "").translate(UPPER))
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[at : at + size]), set()).add(item)
    sizes = {len(key) for key in windows}
    made = []
    for key, text in docs:
        words = BENCH_WORD.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if items_here := windows.get(tuple(words[at : at + size])):
                    hit.update(range(at, at + size))
                    found |= items_here
        names = sorted(str(one) for one in found if one is not None)
        made.append((key, len(words), len(hit), len(names), sha(",".join(names).encode()), bool(hit)))
    return made


def without_windows(docs, window=50):
    """(id, bytes, removed, runs, digest of the rest)."""
    held: dict[bytes, int] = {}
    coded = [(key, (text or "").encode()) for key, text in docs]
    for key, data in coded:
        for at in range(len(data) - window + 1 if key is not None else 0):
            part = data[at : at + window]
            held[part] = min(held.get(part, key), key)
    made = []
    for key, data in coded:
        gone = bytearray(len(data))
        for at in range(len(data) - window + 1 if key is not None else 0):
            if held[data[at : at + window]] < key:
                gone[at : at + window] = b"\1" * window
        runs = sum(1 for at in range(len(gone)) if gone[at] and (not at or not gone[at - 1]))
        rest = bytes(byte for byte, out in zip(data, gone, strict=True) if not out)
        made.append((key, len(data), sum(gone), runs, sha(rest)))
    return made


def near(one, other, edits):
    """Whether few edits lead from one text to the other, by trying all of them."""

    def go(i, j, left):
        while i < len(one) and j < len(other) and one[i] == other[j]:
            i, j = i + 1, j + 1
        if i == len(one) or j == len(other):
            return len(one) - i + len(other) - j <= left
        return left > 0 and (go(i + 1, j, left - 1) or go(i, j + 1, left - 1) or go(i + 1, j + 1, left - 1))

    return abs(len(one) - len(other)) <= edits and go(0, 0, edits)


def repeated_lines(docs, edits=2, min_chars=20):
    """id -> numbers of the lines to remove, for documents with distinct ids; edits link lines of ``min_chars`` and more."""
    places: dict[str, list] = {}
    for key, text in docs:
        for number, line in enumerate((text or "").split("\n")):
            if line.strip():
                places.setdefault(line.strip(), []).append((key, number))
    lines = sorted(places, key=len)
    letters = [Counter(line) for line in lines]
    union = Union(lines)
    for at, line in enumerate(lines):
        for before in range(at - 1, -1, -1):
            if len(lines[before]) < max(min_chars, len(line) - edits):
                break
            if (letters[at] - letters[before]).total() <= edits and near(lines[before], line, edits):
                union.link(line, lines[before])
    groups: dict[str, list] = {}
    for line in lines:
        groups.setdefault(union.root(line), []).extend(places[line])
    gone: dict = {}
    for found in groups.values():
        for key, number in set(found) - {min(found)}:
            gone.setdefault(key, set()).add(number)
    return {key: sorted(numbers) for key, numbers in gone.items()}


def base_counts(text):
    """The contract's counts of the quality rules."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(hit),
        len(words) < 50 or 100 * len(hit) > 50 * len(words),
    )
