"""Substring dedup: matching statistics of streamed texts against sharded FM-indexes.

A shard's pieces (see ``repeats``) are indexed as one text: its Burrows-Wheeler transform
in a wavelet matrix of word numbers, a bit for each of log2(words) levels and word, with
counts every 64 bits.  The pieces then stream past it.  Backward search extends a match
to the left, a word a step, as long as it occurs twice, all pieces in step; where it
ends, all windows that hold the failing stretch are settled at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.repeats import Windows, covered, repeated_windows, unique_ids
from reviewmart.llm.tasks import ship, span_hashes, word_bounds
from reviewmart.llm.texts import unzipped, zipped


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the text's suffixes in order, by doubling; ends on a unique symbol."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, width = len(text), 1
    while True:
        later = np.full(n, 0, np.int64)
        later[: n - width] = rank[width:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key)  # equal keys get one rank, whatever their order
        own = key[order]
        new = np.append(0, np.cumsum(own[1:] != own[:-1]))
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Counts of a symbol before a place, in as many steps as a symbol has bits."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = max(int(symbols - 1).bit_length(), 1)
        self.words, self.counts, self.zeros = [], [], []
        order = values
        for level in range(self.levels - 1, -1, -1):
            bit = ((order >> level) & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, bool)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.words.append(words)
            ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.counts.append(np.concatenate([[0], ones[:-1]]))
            self.zeros.append(int(len(bit) - bit.sum()))
            order = np.concatenate([order[~bit], order[bit]])
        # Where each symbol's run begins at the end: the first place is written last.
        self.begins = np.zeros(symbols, np.int64)
        self.begins[order[::-1]] = np.arange(len(order))[::-1]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            block = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[i][block] + np.bitwise_count(self.words[i][block] & below)
            bit = (symbol >> level) & 1 == 1
            place = np.where(bit, self.zeros[i] + ones, place - ones)
        return place - self.begins[symbol]


class FmIndex:
    """Of a text of symbols, each suffix with a weight."""

    def __init__(self, text: np.ndarray, weight: np.ndarray):
        order = suffix_array(text)
        self.symbols = int(text.max()) + 1
        self.matrix = WaveletMatrix(text[order - 1], self.symbols)
        counts = np.bincount(text, minlength=self.symbols)
        self.before = np.cumsum(counts) - counts
        self.weights = np.concatenate([[0], np.cumsum(weight[order])])
        self.size = len(text)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Suffixes that have the symbol before those from low to high."""
        both = self.matrix.rank(np.tile(symbol, 2), np.concatenate([low, high]))
        begin = self.before[symbol]
        return begin + both[: len(low)], begin + both[len(low) :]


def repeated_in(index: FmIndex, text: np.ndarray, at: np.ndarray, m: np.ndarray, length: int):
    """Which windows of each piece, at ``at`` in the text, occur with weight 2 or more.

    A piece is searched from the end of a stretch of windows back to the first unsettled
    one.  If the stretch occurs twice, so do its windows, and a longer one is tried next;
    if not, a shorter one, down to a single window; if that fails before it is whole, no
    window that holds the failing part occurs twice.
    """
    hits = [np.zeros(x, bool) for x in m]
    piece = np.arange(len(m))
    next_ = np.zeros(len(m), np.int64)  # first unsettled window
    extra = np.full(len(m), length - 1)
    end = np.minimum(next_ + length + extra, m + length - 1)
    place = end.copy()
    low, high = np.zeros(len(m), np.int64), np.full(len(m), index.size)
    while len(piece):
        a, b = index.extend(text[at[piece] + place - 1], low, high)
        good = index.weights[b] - index.weights[a] >= 2
        place = place - good
        low, high = np.where(good, a, low), np.where(good, b, high)
        done = ~good | (place == next_)
        for i in np.flatnonzero(done):
            if good[i]:
                hits[piece[i]][next_[i] : end[i] - length + 1] = True
                next_[i] = end[i] - length + 1
                extra[i] = min(2 * extra[i] + 1, length - 1)
            elif end[i] - next_[i] > length:
                extra[i] = (end[i] - next_[i] - length) // 2
            else:
                next_[i] = place[i]
        if done.any():
            end = np.where(done, np.minimum(next_ + length + extra, m[piece] + length - 1), end)
            place = np.where(done, end, place)
            low, high = np.where(done, 0, low), np.where(done, index.size, high)
            left = next_ < m[piece]
            piece, next_, extra, end, place, low, high = (
                x[left] for x in (piece, next_, extra, end, place, low, high)
            )
    return hits


def judge(contents: list[bytes], n, doc_id, start, m, w: Windows):
    """Windows that occur twice, be it in one place of a piece or in several."""
    raw = b" ".join(contents)
    data = np.frombuffer(raw, np.uint8)
    words = span_hashes(data, *word_bounds(data, np.array([0, len(data)]))[:2])
    size = m.astype(np.int64) + w.length - 1
    number = np.unique(words, return_inverse=True)[1]
    # A separator of its own after each piece sorts before all words.
    at = np.cumsum(size + 1) - size - 1
    text = np.empty(len(words) + len(m), np.int64)
    separators = at + size
    mine = np.ones(len(text), bool)
    mine[separators] = False
    text[mine] = number + len(m)
    text[separators] = np.arange(len(m))
    index = FmIndex(text, np.repeat(n.astype(np.int64), size + 1))
    hits = [np.packbits(x).tobytes() for x in repeated_in(index, text, at, m.astype(np.int64), w.length)]
    return hits, hits


def _strip(batches: Iterator[pa.RecordBatch], w: Windows) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, whole.num_rows, 64):
            batch = whole.slice(low, 64)
            texts = unzipped(batch.column(1))[0]
            out = []
            for text, places in zip(texts, batch.column(2).to_pylist(), strict=True):
                words = text.split()
                gone = covered(places, len(words), w.length)
                kept = b" ".join(words[i] for i in np.flatnonzero(~gone)) if gone.any() else b" ".join(words)
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
            n, removed, sums, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(sums), pa.array([x.decode("utf-8", "replace") for x in kept])],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )


def strip_repeats(docs: DataFrame, length: int = 35, folder: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of (doc_id, text).

    Words lie between ASCII white space.  Every word in a run of ``length`` that also
    starts anywhere else, in any text, is removed; runs are judged on the input.  A null
    text has no words.  Each of several rows with one ``doc_id``, or with none, is a text
    of its own.  Other columns are ignored; an empty table gives none.
    """
    ship(docs.sparkSession)
    w = Windows(words=True, length=length, run=min(16, length), shard=1 << 20)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs, numbered = unique_ids(docs, folder)
    gone = repeated_windows(docs.select("doc_id", "text"), w, judge, folder)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    out = zipped(docs).join(gone, "doc_id", "left").mapInArrow(partial(_strip, w=w), schema)
    if numbered:
        out = out.join(docs.select("doc_id", "real_id"), "doc_id")
        out = out.drop("doc_id").withColumnRenamed("real_id", "doc_id")
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept")
