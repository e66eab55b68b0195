"""Alignment of two tokenizers' tokens by pointer jumping.

Tokenizer A is byte-level, B has pieces with a mark for the space and a byte for what it
lacks.  Both are run over the same bytes, a space and then the text.  Tokens of A and B
whose bytes overlap belong together, so groups end where a token of each ends.  Every
token points to its farthest-right overlapping token; pointers are then replaced by
their pointers' pointers until all point to the last token of their group, which names
it.  That is a few steps over arrays of all tokens of some texts, however long a group.

Two tokens that end together are linked.  One's bytes are then the end of the other's, so
the vocabularies bound the distinct pairs of ids: each token has no more ends than bytes.
That is some hundred thousand pairs, whatever the corpus, and why their counts may be sent
to all tasks.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.segments import SegmentTable, decimals, groups, written
from reviewmart.llm.tasks import ship, stage

SPACE_MARK = "▁"
# Stands for the ids of a segment whose tokens do not give back its bytes.
UNSOUND = [-1]


def byte_letters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, and the byte.

    Visible Latin-1 characters stand for themselves, the others for 256 and on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in set(shown)]
    letters = {chr(x): x for x in shown}
    return letters | {chr(256 + i): x for i, x in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A, a file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # as plain text
        letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.bytes_of = {i: bytes(map(letters.__getitem__, x)) for x, i in vocabulary.items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B, a model of the sentencepiece library, which puts a space first."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes_of = {
            i: bytes([int(x[3:5], 16)])
            if self.model.is_byte(i)
            else x.replace(SPACE_MARK, " ").encode()
            for i, x in enumerate(pieces)
        }
        # Cuts before a space are right only if no piece has one behind something else.
        if any(" " in x.lstrip(SPACE_MARK).replace(SPACE_MARK, " ") for x in pieces):
            raise ValueError(f"{path} has pieces that reach over a space")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([x[1:] for x in texts], num_threads=1)


class Side:
    """One tokenizer with what it made of the segments met so far."""

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.tokenizer = tokenizer
        self.size = max(tokenizer.bytes_of) + 1
        self.lengths = np.zeros(self.size + 1, np.int64)  # the last one for UNSOUND
        for i, x in tokenizer.bytes_of.items():
            self.lengths[i] = len(x)
        self.table = SegmentTable(self._encode)

    def _encode(self, found: list[str]) -> list[list[int]]:
        bytes_of = self.tokenizer.bytes_of
        return [
            ids if b"".join(map(bytes_of.__getitem__, ids)) == x.encode() else UNSOUND
            for x, ids in zip(found, self.tokenizer.encode(found), strict=True)
        ]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(ByteLevel(path_a)), Side(Pieces(path_b))
        self.digits = decimals(max(self.a.size, self.b.size))

    def of(self, texts: pa.Array) -> Iterator[tuple]:
        """(row, ids of A, their groups, ids of B, their groups) of every text, in order.

        A long text comes in several parts, cut where groups end.  None stands for the
        ids of a text, or part, whose tokens do not give back its bytes.
        """
        # Without text there are no tokens, not that of the space either.
        texts = pa.array([" " + x.as_py() if x.as_py() else "" for x in texts], pa.large_string())
        for held in groups(texts):
            found = [s for _, own in held for s in own]
            counts = np.array([len(own) for _, own in held])
            (a, a_size), (b, b_size) = (x.table.look_up(found) for x in (self.a, self.b))
            entry = np.repeat(np.arange(len(held)), counts)
            a_entry, b_entry = np.repeat(entry, a_size), np.repeat(entry, b_size)
            sound = np.ones(len(held), bool)
            sound[a_entry[a < 0]] = False
            sound[b_entry[b < 0]] = False
            a, a_entry = a[sound[a_entry]], a_entry[sound[a_entry]]
            b, b_entry = b[sound[b_entry]], b_entry[sound[b_entry]]
            a_group, b_group = labels(np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b]))
            each = np.arange(len(held) + 1)
            a_at, b_at = np.searchsorted(a_entry, each), np.searchsorted(b_entry, each)
            for i, (row, _) in enumerate(held):
                own_a, own_b = slice(a_at[i], a_at[i + 1]), slice(b_at[i], b_at[i + 1])
                if sound[i]:
                    base = a_group[own_a.start] if own_a.start < own_a.stop else 0
                    yield row, a[own_a], a_group[own_a] - base, b[own_b], b_group[own_b] - base
                else:
                    yield row, None, None, None, None


def labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group, from 0, of each token of A and of B; both have the same bytes.

    ``a_ends`` and ``b_ends`` are the ends of the tokens, none of which is empty.
    """
    n = len(a_ends)
    # The other side's token over a token's last byte reaches as far right, or farther.
    over_a, over_b = np.searchsorted(b_ends, a_ends), np.searchsorted(a_ends, b_ends)
    ends_group = b_ends[over_a] == a_ends if n else np.zeros(0, bool)
    to = np.concatenate([np.where(ends_group, np.arange(n), n + over_a), over_b])
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            break
        to = farther
    number = np.cumsum(ends_group) - 1
    return number[to[:n]], number[to[n:]]


def links(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray):
    """Ids of the linked tokens: in each group its last of A and its last of B."""
    return tuple(x[np.append(g[1:] != g[:-1], True)] if len(x) else x for x, g in ((a, a_group), (b, b_group)))


def listing(a, a_group, b, b_group, digits) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: decimal ids of A and B, group by group."""
    ids = np.concatenate([a, b])
    group = np.concatenate([a_group, b_group])
    side = np.repeat(np.array([0, 1]), [len(a), len(b)])
    order = np.argsort(group * 2 + side, kind="stable")
    ids, group, side = ids[order], group[order], side[order]
    after = np.full(len(ids), ord(","), np.uint8)
    after[:-1][side[1:] > side[:-1]] = ord("|")
    after[:-1][group[1:] > group[:-1]] = ord(";")
    return written(ids, after, digits)[0][:-1].tobytes()


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each pair of files and worker; kept between tasks."""
    key = (path_a, path_b)
    if key not in _aligners:
        _aligners[key] = Aligner(*key)
    return _aligners[key]


COLUMNS = ("a", "a_group", "b", "b_group")


def _whole(parts: list[tuple]) -> list[np.ndarray]:
    """A text's arrays from those of its parts; empty if a part is unsound."""
    if any(x[0] is None for x in parts):
        return [np.zeros(0, np.int64)] * 4
    base, out = 0, []
    for a, a_group, b, b_group in parts:
        out.append((a, a_group + base, b, b_group + base))
        base += int(a_group[-1]) + 1 if len(a_group) else 0
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _by_row(batch: pa.RecordBatch, path_a: str, path_b: str) -> Iterator[tuple[int, list]]:
    row, parts = -1, []
    for new, *part in aligner(path_a, path_b).of(batch.column(1)):
        if new != row and parts:
            yield row, _whole(parts)
            parts = []
        row = new
        parts.append(tuple(part))
    if parts:
        yield row, _whole(parts)


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, found in _by_row(batch, path_a, path_b):
            values = [pa.array(x.astype(np.int32)) for x in found]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in values]
            columns = [batch.column(0).slice(row, 1), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COLUMNS])


SUMMARY = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, links binary"
)


def _summed(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    own = aligner(path_a, path_b)
    zip_ = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        out = []
        for row, found in _by_row(batch, path_a, path_b):
            a, a_group, b, b_group = found
            x, y = links(*found)
            # As numbers that are near each other once sorted, they take less room.
            codes = np.sort(x * own.b.size + y)
            digest = hashlib.sha256(listing(*found, own.digits)).hexdigest() if len(a) else ""
            steps = np.diff(codes, prepend=0).astype("<u8" if codes[-1:].max(initial=0) >> 32 else "<u4")
            n_groups = int(a_group[-1]) + 1 if len(a) else 0
            out.append((row, len(a), len(b), n_groups, len(x), digest, steps.itemsize.to_bytes(1, "big") + zip_.compress(steps.tobytes())))
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        arrays = [pa.array(x, k) for x, k in zip(columns[1:], kinds, strict=True)]
        names = [x.split()[0] for x in SUMMARY.split(", ")]
        ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, *arrays], names=names)


def _codes(packed: pa.Scalar) -> np.ndarray:
    raw = packed.as_buffer()
    kind = f"<u{raw[0:1].to_pybytes()[0]}"
    unzipped = zstandard.ZstdDecompressor().decompress(raw[1:])
    return np.cumsum(np.frombuffer(unzipped, kind), dtype=np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's pairs of ids and their counts; no more pairs than the vocabularies allow."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        new, n = np.unique(np.concatenate([np.zeros(0, np.int64), *map(_codes, batch.column(0))]), return_counts=True)
        codes, where = np.unique(np.concatenate([codes, new]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n]), len(codes)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])


def _judged(
    batches: Iterator[pa.RecordBatch], codes: np.ndarray, counts: np.ndarray, best: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_best, total = [], []
        for packed in batch.column("links"):
            at = np.searchsorted(codes, _codes(packed))
            n_best.append(int(best[at].sum()))
            total.append(int(counts[at].sum()))
        batch = batch.drop_columns(["links"])
        columns = [*batch.columns, pa.array(n_best, pa.int64()), pa.array(total, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "n_best", "count_sum"])


def _texts(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, a, a_group, b, b_group`` of every row of (doc_id, text).

    ``a`` and ``b`` are the ids that the tokenizers of these files make of a space and the
    text, special tokens' strings being plain text, and ``a_group`` and ``b_group`` each
    one's group, from 0.  Null and empty texts have no tokens, nor have texts whose
    tokens of either side do not give back their bytes (B reads its mark U+2581 as a
    space).  Rows are aligned one by one, whatever their ``doc_id``; a null one stays
    null.  Other columns are ignored; an empty table gives none.  A text is whole in its
    task; what is made of it is held slab by slab until its row is done.
    """
    work = partial(_align, path_a=path_a, path_b=path_b)
    lists = ", ".join(f"{c} array<int>" for c in COLUMNS)
    return _texts(docs).mapInArrow(work, f"doc_id long, {lists}")


def link_counts(summaries: DataFrame, size_b: int) -> DataFrame:
    """``a, b, n``: how many links of all rows hold this pair of ids."""
    found = summaries.select("links").mapInArrow(_counted, "code long, n long")
    found = found.groupBy("code").agg(F.sum("n").alias("n"))
    return found.select(
        F.expr(f"int(code div {size_b})").alias("a"), F.expr(f"int(code % {size_b})").alias("b"), "n"
    )


def summarize(docs: DataFrame, path_a: str, path_b: str, folder: str | None = None) -> DataFrame:
    """(summaries, with each row's links in ``links``), written once for all readers."""
    work = partial(_summed, path_a=path_a, path_b=path_b)
    return stage(_texts(docs).mapInArrow(work, SUMMARY), "aligned", folder)


def describe(docs: DataFrame, path_a: str, path_b: str, folder: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` of every row.

    ``count_sum`` adds the corpus-wide counts of the row's links' pairs of ids; ``n_best``
    are those links whose count is the highest that their id of B has anywhere.
    ``groups_sha256`` sums ``a1,a2|b1;a3|b2,b3``, and is '' without tokens, where all
    numbers are 0.  Odd rows are treated as :func:`align` does, and repeated rows count
    as often as they occur.
    """
    size_b = aligner(path_a, path_b).b.size
    rows = summarize(docs, path_a, path_b, folder)
    # As many rows as the vocabularies allow pairs, see above.
    table = link_counts(rows, size_b).orderBy("a", "b").toArrow()
    a, b, n = (np.array(table.column(x).combine_chunks()) for x in ("a", "b", "n"))
    highest = np.zeros(size_b, np.int64)
    np.maximum.at(highest, b, n)
    codes = a.astype(np.int64) * size_b + b
    work = partial(_judged, codes=codes, counts=n, best=n == highest[b])
    schema = SUMMARY.replace("links binary", "n_best long, count_sum long")
    return rows.mapInArrow(work, schema)
