"""Token ids of whole texts; every distinct word is encoded once by a worker.

The tokenizer drops white space, so no token holds any: a text's ids are those of
its pieces between ASCII white space, one after the other.

A worker keeps words and their ids in arrays, not as objects: a word of up to 15 bytes
is two numbers, its last byte the size, and is looked up, with all others of its piece of
text, in one open table.  Longer ones, which are rare, are keys of a dictionary.

Most of a new word's time goes into the tokenizer's normal forms and split rule.  Of
words of plain characters (visible ASCII and the letters of Latin-1) both are known
beforehand, if the tokenizer's are those in ``FORMS``: such characters are composed and
blank-free, so they are lower-cased and split here, and only distinct parts go to the
tokenizer's model.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from itertools import chain

import numpy as np

from reviewmart.llm.tasks import MIX, MIX2, give_back, mixed, word_bounds

# Words a worker keeps before it starts anew; some 40 MB.
KEPT_WORDS = 650_000
# New words that are encoded together.
NEW_WORDS = 512

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FORMS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The split rule over lower-cased plain characters; words end where lines do.
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")

# The byte level writes these bytes as characters from U+0100 on.  A space stays, between parts.
BYTES = [*range(33), *range(127, 161), 173]
BYTE_LEVEL = "".join(
    chr(256 + BYTES.index(x)) if x in BYTES and x != 32 else chr(x) for x in range(256)
)
LINE_END = BYTE_LEVEL[10]

# Bytes of a word that its two numbers hold.
SHORT = 15


class Words:
    """Numbers of distinct words in order of first sight."""

    def __init__(self):
        self.long: dict[bytes, int] = {}
        self.count = 0
        # First 8 bytes; the other bytes and the size, which is 0 in a free place.
        self.table = np.zeros((1 << 16, 2), np.uint64)
        self.of_place = np.zeros(1 << 16, np.int32)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mixed(low * MIX ^ high * MIX2) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers, -1 where a word is new."""
        number = np.full(len(low), -1, np.int64)
        slot, left = self._slots(low, high), np.arange(len(low))
        while len(left):
            rows = self.table[slot]
            same = (rows[:, 0] == low[left]) & (rows[:, 1] == high[left])
            number[left[same]] = self.of_place[slot[same]]
            on = ~same & (rows[:, 1] > 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.table) - 1)
        return number

    def _put(self, rows: np.ndarray, number: np.ndarray) -> None:
        """Add distinct rows that are not in the table."""
        slot = self._slots(rows[:, 0], rows[:, 1])
        while len(rows):
            free = self.table[slot, 1] == 0
            # Of several rows for a free place one stays there.
            self.table[slot[free]] = rows[free]
            in_ = (self.table[slot] == rows).all(axis=1)
            self.of_place[slot[in_]] = number[in_]
            rows, number, slot = rows[~in_], number[~in_], (slot[~in_] + 1) & (len(self.table) - 1)

    def _grow(self, count: int) -> None:
        """Room for so many words; three in ten places stay free."""
        size = len(self.table)
        while 7 * size < 10 * count:
            size *= 2
        if size > len(self.table):
            taken = self.table[:, 1] > 0
            rows, number = self.table[taken], self.of_place[taken]
            self.table, self.of_place = np.zeros((size, 2), np.uint64), np.zeros(size, np.int32)
            self._put(rows, number)

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Each word's number, and where the new words are, in order of their numbers."""
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        eight = np.ndarray((len(data) + 9,), "<u8", padded, strides=(1,))
        size = ends - starts
        number = np.empty(len(size), np.int64)
        every, short = np.uint64((1 << 64) - 1), size <= SHORT
        n, at = size[short].astype(np.uint64), starts[short]
        bits = n << np.uint64(3)
        low = eight[at] & (every >> (np.uint64(64) - np.minimum(bits, np.uint64(64))))
        # A shift by 64 bits is not defined, so no bytes are asked for by and.
        bits = np.maximum(bits, np.uint64(64)) - np.uint64(64)
        high = eight[at + 8] & ((np.uint64(1) << bits) - np.uint64(1)) | (n << np.uint64(56))
        found = self._find(low, high)
        new = np.flatnonzero(found < 0)
        order = new[np.lexsort((new, low[new], high[new]))]
        first = np.ones(len(order), bool)
        first[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
        firsts = order[first]
        found[order] = self.count + np.cumsum(first) - 1
        number[short] = found
        self.count += len(firsts)
        self._grow(self.count)
        self._put(np.stack([low[firsts], high[firsts]], 1), found[firsts])
        places = np.flatnonzero(short)[firsts].tolist()
        for i in np.flatnonzero(~short).tolist():
            word = data[starts[i] : ends[i]].tobytes()
            if word not in self.long:
                self.long[word] = self.count
                self.count += 1
                places.append(i)
            number[i] = self.long[word]
        return number, places


def _longer(values: np.ndarray, size: int) -> np.ndarray:
    """The same with room for ``size`` at least."""
    if size <= len(values):
        return values
    more = max(size, len(values) * 5 // 4) - len(values)
    return np.concatenate([values, np.zeros(more, values.dtype)])


class WordEncoder:
    """Ids of words, end to end, and where those of each number begin."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        # Plain words with an added token in them, which goes before any split, are not.
        added = [x["content"] for x in made["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        known = all(made[x] == form for x, form in FORMS.items())
        self.model = self.tokenizer.model if known else None
        del made
        give_back()  # the vocabulary as JSON takes more than the tokenizer
        self.forget()

    def forget(self) -> None:
        self.words = Words()
        few = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.ids = np.zeros(1 << 16, np.uint16 if few else np.uint32)  # the first is a last id's place
        self.begins = np.zeros(1 << 16, np.uint32)
        self.sizes = np.zeros(1 << 16, np.int32)
        self.used = 1

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in any order; where each word's begin, and how many it has."""
        own = np.array(
            [
                bool(self.model and PLAIN.fullmatch(x) and not self.added.search(x))
                for x in words
            ],
            bool,
        )
        plain = [x for x, is_own in zip(words, own, strict=True) if is_own]
        rest = [x for x, is_own in zip(words, own, strict=True) if not is_own]
        encoded = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        others = [x.ids for x in encoded]
        sizes = np.zeros(len(words), np.int64)
        sizes[~own] = list(map(len, others))
        flat = np.zeros(0, np.int64)
        if plain:
            parts = " ".join(PARTS.findall("\n".join(plain).lower()))
            parts = codecs.charmap_decode(parts.encode(), "strict", BYTE_LEVEL)[0].split(" ")
            tokenize = self.model.tokenize
            known = {x: [token.id for token in tokenize(x)] for x in dict.fromkeys(parts)}
            known[LINE_END] = [-1]
            flat = np.array(list(chain.from_iterable(map(known.__getitem__, parts))), np.int64)
            ends = np.append(np.flatnonzero(flat < 0), len(flat))
            sizes[own] = np.diff(ends, prepend=-1) - 1
            flat = flat[flat >= 0]
        begins = np.zeros(len(words), np.int64)
        begins[own] = np.cumsum(sizes[own]) - sizes[own]
        begins[~own] = len(flat) + np.cumsum(sizes[~own]) - sizes[~own]
        flat = np.concatenate([flat, np.array(list(chain.from_iterable(others)), np.int64)])
        return flat.astype(np.uint32), begins, sizes

    def ids_of(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        flat, begins, sizes = self._encoded(words)
        return [flat[a : a + n].tolist() for a, n in zip(begins, sizes, strict=True)]

    def learn(self, known: int, words: list[str]) -> None:
        """Keep the ids of new words; there are ``known`` before them."""
        for low in range(0, len(words), NEW_WORDS):
            flat, begins, sizes = self._encoded(words[low : low + NEW_WORDS])
            self.ids = _longer(self.ids, self.used + len(flat))
            self.begins = _longer(self.begins, known + len(sizes))
            self.sizes = _longer(self.sizes, known + len(sizes))
            self.ids[self.used : self.used + len(flat)] = flat
            self.begins[known : known + len(sizes)] = self.used + begins
            self.sizes[known : known + len(sizes)] = sizes
            self.used += len(flat)
            known += len(sizes)

    def encode(self, data: np.ndarray, offsets: np.ndarray, last: int):
        """Ids of each text and then ``last``; and where each text's ids begin and end."""
        if self.words.count > KEPT_WORDS:
            self.forget()
        starts, ends, before = word_bounds(data, offsets)
        known = self.words.count
        number, new = self.words.numbers(data, starts, ends)
        raw = data.tobytes()
        self.learn(known, [raw[starts[i] : ends[i]].decode("utf-8") for i in new])
        begin = np.insert(self.begins[number].astype(np.int64), before[1:], 0)
        size = np.insert(self.sizes[number], before[1:], 1)
        total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        at = total[before + np.arange(len(before))]
        place = np.arange(total[-1])
        place += np.repeat(begin - total[:-1], size)
        out = self.ids[place].astype(np.uint32)
        out[at[1:] - 1] = last
        return out, at


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each file and worker; kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
