"""Byte-level BPE by dynamic programming over prefixes, and its way back.

Merging the pair of lowest rank, leftmost first, is local: what a piece of text becomes
is a row of tokens in which each token and the next, encoded alone, stay as they are, and
there is only one such row.  So every prefix of a piece has one valid last token: the
token that ends there and stays beside the last token of the prefix before it.  That one
number a byte is all there is to store.  More bytes need only their own; after an edit,
what stands before it is still right.

``Prefixes`` is one piece, ``EncodedText`` a text that is edited; ``encode``, ``decode``
and ``describe`` work on tables.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.segments import SegmentTable, decimals, groups, written
from reviewmart.llm.tasks import ship

# Answers about pairs of tokens that a worker keeps before it starts anew.
KEPT_PAIRS = 4_000_000
# A match looks at so many characters behind its end at most, as "'" does in "'re".
LOOKS_AHEAD = 3
# Stands for the token before the first.
NOTHING = -1


class Vocabulary:
    """The tokens of a rank file (base64 token and rank in each line), by rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.never = max(self.tokens) + 1  # the rank of what is no token
        # What is known of the tokens to the left of each token, by rank: whether both stay.
        self.known: dict[int, dict[int, bool]] = {rank: {} for rank in self.tokens}
        self.pairs = 0
        self.ending = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.ending.add_word(token.decode("latin-1"), (self.known[rank], rank, len(token)))
        self.ending.make_automaton()

    def merged(self, raw: bytes) -> list[int]:
        """Plain merging, lowest rank and leftmost first; for short texts."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        rank, never = self.rank.get, self.never
        ranks = [rank(x + y, never) for x, y in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != never:
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            for i in (at - 1, at):
                if 0 <= i < len(ranks):
                    ranks[i] = rank(parts[i] + parts[i + 1], never)
        return [self.rank[x] for x in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes, joined, are encoded to just these two.

        With NOTHING to the left: whether the token's own bytes are.
        """
        known = self.known[right].get(left)
        if known is None:
            if self.pairs >= KEPT_PAIRS:
                self.pairs = 0
                for lefts in self.known.values():
                    lefts.clear()
            tokens = [x for x in (left, right) if x != NOTHING]
            known = self.known[right][left] = self.merged(self.decode(tokens)) == tokens
            self.pairs += 1
        return known

    def ids(self, piece: bytes) -> Sequence[int]:
        """Of one match of the split pattern; a match that is a token is that token."""
        known = self.rank.get(piece)
        return [known] if known is not None else Prefixes(self, piece).ids()

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Prefixes:
    """The last token of every prefix of a piece: ``last[i]`` ends with byte i."""

    def __init__(self, vocabulary: Vocabulary, raw: bytes = b""):
        self.vocabulary = vocabulary
        self.raw = b""
        self.last: list[int] = []
        self.append(raw)

    def append(self, more: bytes) -> None:
        """Add bytes; the last tokens of earlier prefixes stay what they were."""
        words, last = self.vocabulary, self.last
        self.raw += more
        low = max(len(last) - words.longest + 1, 0)
        due, fits, push = len(last), words.fits, last.append
        for end, found in words.ending.iter(self.raw[low:].decode("latin-1")):
            # Tokens come by their end, the longest first; one of them is valid.
            if end + low != due:
                continue
            known, token, size = found
            left = last[due - size] if due >= size else NOTHING
            fit = known.get(left)
            if fit or (fit is None and fits(left, token)):
                push(token)
                due += 1
        if due != len(self.raw):
            raise ValueError("the vocabulary lacks tokens of one byte")

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes."""
        self.raw = self.raw[:size]
        del self.last[size:]

    def ids(self) -> list[int]:
        out, at, tokens, last = [], len(self.raw) - 1, self.vocabulary.tokens, self.last
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= len(tokens[token])
        out.reverse()
        return out


class EncodedText:
    """A text and its ids; an edit encodes anew only what it reaches.

    Pieces of the pattern before the edit stay, and behind it all from where matches
    begin at an old place again.  A piece that is cut keeps the prefixes before the cut.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.text = ""
        self.starts: list[int] = []
        self.pieces: list[Prefixes] = []
        self.encoded = 0  # bytes so far that were encoded, for those who count
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in the place of characters ``start`` to ``stop``."""
        if not 0 <= start <= stop <= len(self.text):
            raise ValueError(f"no characters {start} to {stop} in {len(self.text)}")
        old_starts, old = self.starts, self.pieces
        ends = [*old_starts[1:], len(self.text)]
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        first = int(np.searchsorted(np.array(ends), start - LOOKS_AHEAD, "right")) if old else 0
        later = {x + shift: i for i, x in enumerate(old_starts) if x >= stop}
        starts, pieces, rest = old_starts[:first], old[:first], len(old)
        reuse = first
        for match in self.pattern.finditer(self.text, old_starts[first] if first < len(old) else ends[-1] if old else 0):
            if match.start() >= start + len(new) and match.start() in later:
                rest = later[match.start()]
                break
            raw = match.group().encode()
            piece = Prefixes(self.vocabulary)
            if reuse < len(old) and old_starts[reuse] == match.start() < start:
                piece, reuse = old[reuse], reuse + 1
            same = len(_common(piece.raw, raw))
            piece.cut(same)
            piece.append(raw[same:])
            self.encoded += len(raw) - same
            starts.append(match.start())
            pieces.append(piece)
        self.starts = starts + [x + shift for x in old_starts[rest:]]
        self.pieces = pieces + old[rest:]

    def ids(self) -> list[int]:
        rank = self.vocabulary.rank
        return [i for x in self.pieces for i in ([rank[x.raw]] if x.raw in rank else x.ids())]


def _common(a: bytes, b: bytes) -> bytes:
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return a[: int(differ[0]) if len(differ) else n]


class Encoder:
    """Of whole texts; each distinct segment is split and encoded once."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.table = SegmentTable(self._encode)
        self.digits = decimals(max(self.vocabulary.tokens))

    def _encode(self, found: list[str]) -> list[list[int]]:
        ids = self.vocabulary.ids
        return [[i for piece in self.split(x) for i in ids(piece.encode())] for x in found]

    def of(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of every text; a long one comes in several parts, in order."""
        for group in groups(texts):
            ids, sizes = self.table.look_up([s for _, own in group for s in own])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            for row, own in group:
                yield row, ids[ends[at] : ends[at + len(own)]]
                at += len(own)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One for each file and worker; kept between tasks."""
    key = (path, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(path, pattern)
    return _encoders[key]


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, held = -1, []
        for new, ids in encoder(path, pattern).of(batch.column(1)):
            if new != row and held:
                yield _ids(batch, row, held)
                held = []
            row = new
            held.append(ids)
        if held:
            yield _ids(batch, row, held)


def _ids(batch: pa.RecordBatch, row: int, held: list[np.ndarray]) -> pa.RecordBatch:
    ids = np.concatenate(held).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))
    return pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), lists], names=["doc_id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    decode = encoder(path, pattern).vocabulary.decode
    for batch in batches:
        raw = [decode(x.values.to_pylist() if x.is_valid else []) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "decoded"]
        )


def _describe(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    own = encoder(path, pattern)
    space = np.uint8(32)
    for batch in batches:
        n = np.zeros(batch.num_rows, np.int64)
        sums = [(hashlib.sha256(), hashlib.sha256()) for _ in range(batch.num_rows)]
        for row, ids in own.of(batch.column(1)):
            if not len(ids):
                continue
            text = written(ids, space, own.digits)[0].tobytes()
            # One space between two ids: none before the first.
            sums[row][0].update((b" " if n[row] else b"") + text[:-1])
            sums[row][1].update(own.vocabulary.decode(ids.tolist()))
            n[row] += len(ids)
        columns = [batch.column(0), pa.array(n)]
        columns += [pa.array([x[i].hexdigest() for x in sums], pa.string()) for i in (0, 1)]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _texts(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every row of (doc_id, text), by the ranks of the file ``path``.

    Each match of ``pattern``, the byte-level split rule, is encoded on its own, without
    special tokens: their strings are plain text.  Null and empty texts have no ids.  Rows
    are encoded one by one, whatever their ``doc_id``; a null one stays null.  Other columns
    are ignored; an empty table gives none.  Texts are never cut, but for where a space
    stands before a visible character, where no token reaches over.
    """
    work = partial(_encode, path=path, pattern=pattern)
    return _texts(docs).mapInArrow(work, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (bytes) of every row of (doc_id, ids).

    Null and empty lists give no bytes; an id that the vocabulary lacks, or null, is an error.
    """
    ship(rows.sparkSession)
    rows = rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    work = partial(_decode, path=path, pattern=pattern)
    return rows.mapInArrow(work, "doc_id long, decoded binary")


def describe(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, encoded and decoded.

    The sums are of the decimal ids with one space between two, and of the bytes that the
    ids decode to; both in lowercase hex.  Odd rows are treated as :func:`encode` does.
    """
    work = partial(_describe, path=path, pattern=pattern)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _texts(docs).mapInArrow(work, schema)
