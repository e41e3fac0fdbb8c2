"""Pre-tokens of byte-level BPE: cutting texts so that each distinct part is encoded once.

A text may be cut before any blank that is followed by a visible character:
the pattern gives the same matches on both sides as on the whole, because a run
of white space before such a blank is a match of its own either way. The parts
repeat a lot, so their encodings are kept in a memo of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from typing import Any

import regex

# A blank in front of white space or the end is no place to cut.
_NO_CUT = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")


def pre_token_pattern(pattern: str) -> regex.Pattern:
    """``pattern`` with white space meant as Unicode's White_Space property."""
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def parts(text: str) -> list[str]:
    """The first part, then the parts that follow a blank (which is left out)."""
    return _CUT.split(text) if _NO_CUT.search(text) else text.split(" ")


class PartMemo:
    """Values of text parts, computed together for those not seen lately.

    ``encode`` maps distinct pre-tokens to values, ``combine`` makes one value of
    those of a part. At most about ``limit`` parts and pre-tokens are kept between calls.
    """

    def __init__(self, pattern: str, encode: Callable[[list[str]], Sequence[Any]],
                 combine: Callable[[list[Any]], Any], limit: int = 400_000) -> None:
        self.find = pre_token_pattern(pattern).findall
        self.encode, self.combine, self.limit = encode, combine, limit
        self.heads: dict[str, Any] = {}
        self.tails: dict[str, Any] = {}
        self.pieces: dict[str, Any] = {}

    def values(self, texts: Sequence[str]) -> list[tuple[Any, Iterable[Any]]]:
        """For each text the value of its first part and an iterator over the others."""
        if len(self.heads) + len(self.tails) > self.limit:
            self.heads, self.tails = {}, {}
        if len(self.pieces) > self.limit:
            self.pieces = {}
        cut = [parts(t) for t in texts]
        heads = {p[0] for p in cut} - self.heads.keys()
        tails = set()
        for p in cut:
            tails.update(p[1:])
        tails -= self.tails.keys()
        self._learn(self.heads, heads, "")
        self._learn(self.tails, tails, " ")
        get = self.tails.__getitem__
        return [(self.heads[p[0]], map(get, p[1:])) for p in cut]

    def _learn(self, memo: dict[str, Any], new: set[str], before: str) -> None:
        known, combine, find = self.pieces, self.combine, self.find
        # A part of letters only is one match; the pattern is spared for the others.
        single = {p: before + p for p in new if p.isalpha()}
        found = {p: find(before + p) for p in new if p not in single}
        pieces = set(single.values())
        pieces.update(*found.values())
        distinct = list(pieces - known.keys())
        known.update(zip(distinct, self.encode(distinct), strict=True))
        for p, piece in single.items():
            memo[p] = combine([known[piece]])
        for p, own in found.items():
            memo[p] = combine([known[q] for q in own])
