"""Texts in segments that tokenizers treat alike wherever they stand.

A segment begins at a space that a visible character follows and no space precedes.  No
token of the byte-level and piece vocabularies used here reaches over such a place, and no
split rule looks back over it, so a text's ids are those of its segments, one after the
other.  A worker encodes each distinct segment once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

# Python's \S leaves out more blanks than any of the split rules: cuts are too few at worst.
CUT = re.compile(r"(?<! ) (?=\S)")
# Characters of text that are cut into segments, and looked up, at a time.
SLAB = 1 << 20
# What a worker keeps before it starts anew: segments, and characters in them.
KEPT_SEGMENTS, KEPT_CHARS = 1_000_000, 1 << 25


def slabs(text: str) -> Iterator[str]:
    """The text in pieces of about SLAB characters, cut where segments begin."""
    low = 0
    while len(text) - low > SLAB:
        cut = CUT.search(text, low + SLAB)
        if not cut:
            break
        yield text[low : cut.start()]
        low = cut.start()
    yield text[low:] if low else text


def segments(text: str) -> list[str]:
    """All segments of a text; joined they are the text."""
    if not text:
        return []
    first, *others = CUT.split(text)
    found = [" " + x for x in others]
    return [first, *found] if first else found


def groups(texts: pa.Array) -> Iterator[list[tuple[int, list[str]]]]:
    """(row, segments) of all texts in lists of about SLAB characters; null is empty.

    Every row comes at least once; a long text comes slab by slab, in order.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        for slab in slabs(text.as_py() or ""):
            held.append((row, segments(slab)))
            size += len(slab)
            if size >= SLAB:
                yield held
                held, size = [], 0
    if held:
        yield held


class SegmentTable(dict):
    """A segment's number in order of first sight, and what it is encoded to, end to end."""

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.chars = 0
        self.ids = np.zeros(1 << 12, np.int64)
        self.bounds = np.zeros(1, np.int64)

    def __missing__(self, segment: str) -> int:
        self.new.append(segment)
        number = self[segment] = len(self)
        return number

    def look_up(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these segments, one after the other, and each segment's number of ids."""
        if len(self) > KEPT_SEGMENTS or self.chars > KEPT_CHARS:
            self.forget()
        number = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        if self.new:
            self._learn()
        begin = self.bounds[number]
        size = self.bounds[number + 1] - begin
        before = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(begin - before, size)
        return self.ids[at], size

    def _learn(self) -> None:
        made = self.encode(self.new)
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        end = int(self.bounds[-1])
        need = end + int(sizes.sum())
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need, len(self.ids)), np.int64)])
        self.ids[end:need] = np.fromiter((i for x in made for i in x), np.int64, need - end)
        self.bounds = np.concatenate([self.bounds, end + np.cumsum(sizes)])
        self.chars += sum(map(len, self.new))
        self.new = []


def decimals(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 to ``largest`` as rows of bytes, left-aligned, and their number."""
    width = len(str(largest))
    numbers = np.arange(largest + 1).astype(f"S{width}")
    return numbers.view(np.uint8).reshape(-1, width), np.char.str_len(numbers)


def written(ids: np.ndarray, after: np.ndarray, table: tuple[np.ndarray, np.ndarray]):
    """Ids in decimal as bytes, each followed by its byte ``after``; where each one ends."""
    digits, sizes = table
    size = sizes[ids]
    rows = np.empty((len(ids), digits.shape[1] + 1), np.uint8)
    rows[:, :-1] = digits[ids]
    rows[np.arange(len(ids)), size] = after
    inside = np.arange(rows.shape[1]) <= size[:, None]
    return rows[inside], np.cumsum(size + 1)
