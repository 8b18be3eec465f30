"""Splitting text into the pieces that tokenizers encode one by one, and remembering their ids."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: White space of Unicode, as the tokenizers' patterns have it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters and numbers below U+0250; all of Latin Extended-A and -B are letters.
LATIN_L = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
LATIN_N = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
_BEYOND_LATIN = re.compile("[^\\x00-\\u024f]")


class Splitter:
    """All matches of a pattern written with {L}, {N} and {S} for letters, numbers and white space.

    Texts of Latin letters take the faster standard engine, with the same classes spelt out.
    """

    def __init__(self, pattern: str):
        fill = lambda n, l, s: pattern.replace("{N}", n).replace("{L}", l).replace("{S}", s)  # noqa: E731, E741
        self.latin = re.compile(fill(LATIN_N, LATIN_L, SPACE))
        self.any = regex.compile(fill(r"\p{N}", r"\p{L}", SPACE))

    def __call__(self, text: str) -> list[str]:
        return (self.any if beyond_latin(text) else self.latin).findall(text)


def beyond_latin(text: str) -> bool:
    """Whether a character lies beyond U+024F. Most texts fit one byte a character, which shows at once."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _BEYOND_LATIN.search(text) is not None
    return False


class _Known(dict):
    """Encodings by piece; asking for one that isn't there notes it."""

    def __init__(self):
        self.asked: list[str] = []

    def __missing__(self, piece: str) -> bytes:
        self.asked.append(piece)
        return b""


class Memory:
    """Encodings of pieces. Holds a bounded number: the older half goes when it is full."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], limit: int = 400_000):
        self.encode_many, self.limit, self.new, self.old = encode_many, limit, _Known(), {}

    def __call__(self, pieces: list[str]) -> bytes:
        out = b"".join(map(self.new.__getitem__, pieces))
        if not self.new.asked:
            return out
        if len(self.new) > self.limit:
            self.old, self.new = dict(self.new), _Known()
            self.new.asked = pieces
        missing = set(self.new.asked)
        self.new.asked = []
        old = {w: f for w in missing if (f := self.old.get(w)) is not None}
        self.new.update(old)
        if unseen := [w for w in missing if w not in old]:
            self.new.update(zip(unseen, self.encode_many(unseen), strict=True))
        return b"".join(map(self.new.__getitem__, pieces))
