"""Encode texts match by match with a bounded cache, for byte-level BPE vocabularies.

Byte-level BPE never merges across the matches of its splitting pattern, so each match is encoded
for itself and most are found in a dictionary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import regex

MATCHES = 400_000
#: The splitting pattern of the public rank files; for texts whose characters are all below U+0250,
#: where its classes are short lists, the standard library splits the same in half the time.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, BLANK = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
SPLIT_LOW = (
    rf" ?[{LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+"
    rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
HIGH = re.compile("[ɐ-\U0010ffff]")


@lru_cache(maxsize=1)
def byte_letters() -> tuple[str, ...]:
    """A printable character for every byte: itself where it has one, else one above 255."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return tuple(chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256))


def spelled(match: str) -> str:
    """The UTF-8 bytes of a text, each as its printable character."""
    return match.encode().decode("latin-1").translate(byte_letters())


def splitter(pattern: str) -> Callable[[str], list[str]]:
    split = regex.compile(pattern).findall
    if pattern != SPLIT:
        return split
    split_low, high = re.compile(SPLIT_LOW).findall, HIGH.search
    return lambda text: split(text) if high(text) else split_low(text)


class Known(dict):
    """Match -> its ids as native 32-bit integers; what is not known is encoded when asked for.

    At ``limit`` matches the older half of what is known makes room: the full table is kept as the
    former one, and what is still in use moves back from there.
    """

    def __init__(self, encode_match: Callable[[str], list[int]], limit: int):
        super().__init__()
        self.encode_match, self.limit, self.former = encode_match, limit, {}

    def __missing__(self, match: str) -> bytes:
        ids = self.former.get(match)
        if ids is None:
            ids = array("I", self.encode_match(match)).tobytes()
        if len(self) >= self.limit:
            self.former = dict(self)
            self.clear()
        self[match] = ids
        return ids


class MatchEncoder:
    """``encode_match`` gives the ids of one match of the pattern."""

    def __init__(self, pattern: str, encode_match: Callable[[str], list[int]], limit: int = MATCHES):
        self.split = splitter(pattern)
        self.known = Known(encode_match, limit)

    def __call__(self, text: str) -> bytes:
        """The ids of a text as native 32-bit integers, joined."""
        return b"".join(map(self.known.__getitem__, self.split(text)))
