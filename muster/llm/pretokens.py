"""Cutting texts into words for a byte-level BPE, and a bounded memory of words.

The pattern's matches are encoded independently, so a text's ids are those of
its words in order, and a task encodes a word once however often it occurs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import public_tokenizers
import regex

words_of = regex.compile(public_tokenizers.PATTERN).findall
CACHED = 1_000_000
# A space inside white space, or at a text's end after some: no match begins there.
_inside_white_space = re.compile(r"\s (?:\s|\Z)").search


def stretches(text: str) -> list[str] | None:
    """What lies between a text's spaces, or None where a space may not begin a match.

    No match of the pattern goes on over a space that follows something else than
    white space, nor over the last of several white spaces.  So the words of a text
    are those of its stretches, each with the space before it (``spelt``).
    """
    if _inside_white_space(text):
        return None
    parts = text.split(" ")
    parts[0] = " " + parts[0]  # no other part holds a space: this one has none before it
    return parts


def spelt(stretch: str) -> str:
    return stretch[1:] if stretch[:1] == " " else " " + stretch


def stretch_of(word: str) -> str:
    """The stretch that is spelt as the word."""
    return word[1:] if word[:1] == " " and " " not in word[1:] else " " + word


class Memory:
    """Values of keys, found by ``find`` for many keys at once and kept for a while.

    Between calls it holds at most two generations of ``limit`` keys and what one
    call added: when the young generation is full, the old one goes.
    """

    def __init__(self, find: Callable[[list], Iterable], limit: int = CACHED):
        self.find = find
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def values(self, groups: list[list]) -> list[list]:
        """The values of each group's keys, in order.  No value is None."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = [list(map(young.get, group)) for group in groups]
        unknown: dict = {}
        holes = []
        for group, values in zip(groups, found):
            places = [i for i, value in enumerate(values) if value is None]
            if places:
                holes.append((group, values, places))
            for at in places:
                key = group[at]
                if key in old:
                    young[key] = old[key]
                else:
                    unknown[key] = None
        if unknown:
            keys = list(unknown)
            young.update(zip(keys, self.find(keys), strict=True))
        for group, values, places in holes:
            for at in places:
                values[at] = young[group[at]]
        return found
