"""Best-fit packing: length patterns fitted to the length histogram, then residuals.

Token ids of every document, cut into pieces that fit a sequence, are counted by
length.  The plan depends on that histogram alone, which has as many rows as a
sequence has tokens, whatever the corpus:

1. lengths are rounded up to classes, and patterns of a few classes that fill a
   sequence are enumerated;
2. non-negative least squares finds how often to repeat each pattern;
3. the repeats, rounded down, open sequences and put all classes of their pattern
   but the last one in, longest pieces first;
4. what is left, the last ones among it, goes, longest first, where it leaves the
   least room.

Patterns of three pieces put two together that best fit would part: many lengths below
half a sequence pack better by them.  Where short pieces abound they fill any room, and
patterns that use them up first are worse than best fit.  So steps 3 and 4 are done for
several shares of the repeats, and the plan of the fewest sequences counts, among equals
that of the largest share.

A piece finds its place by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmart.llm.bpe import encoder
from reviewmart.llm.tasks import chunks, give_back, ship, spread, stage

# With patterns of two pieces the first one is over half a sequence, so best fit would
# open a sequence for it too: they change nothing.
CLASSES = 128
PIECES_PER_PATTERN = 3
# Parts of the patterns' repeats that are tried; with 0 best fit is alone.
SHARES = (1.0, 0.95, 0.9, 0.8, 0.65, 0.5, 0.35, 0.2, 0.1, 0.05, 0.02, 0.0)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(
    batches: Iterator[pa.RecordBatch], tokenizer: str, last_id: int, limit: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in chunks(batch):
            ids, at = encoder(tokenizer).encode(data, offsets, last_id)
            size = np.diff(at)
            doc, piece = spread(-(-size // limit))
            start = piece * limit
            length = np.minimum(size[doc] - start, limit)
            raw = ids.astype("<u4")
            sums = [
                zlib.crc32(raw[a : a + n].tobytes())
                for a, n in zip(at[doc] + start, length, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
    give_back()


def token_pieces(docs: DataFrame, tokenizer: str, last_id: int, limit: int) -> DataFrame:
    """Pieces of at most ``limit`` ids of every whole text of (doc_id, text)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    cut = partial(_cut, tokenizer=tokenizer, last_id=last_id, limit=limit)
    return docs.mapInArrow(cut, PIECES)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets (Lawson and Hanson)."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-9 * max(1.0, float(np.abs(b).max())):
            break
        free[best] = True
        while True:
            trial = np.zeros_like(x)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (trial <= 0)
            if not low.any():
                x = trial
                break
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + step * (trial - x)
            free &= x > 1e-12
            x[~free] = 0
            if not free.any():
                break
    return x


def patterns(total: int, most: int) -> list[tuple[int, ...]]:
    """Descending tuples of at most ``most`` positive numbers that sum to ``total``."""
    out = []

    def extend(head: tuple[int, ...], left: int, top: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) < most:
            least = -(-left // (most - len(head)))
            for x in range(min(left, top), least - 1, -1):
                extend((*head, x), left - x, x)

    extend((), total, total)
    return out


def pattern_repeats(
    counts: np.ndarray, most: int, exact: bool = False
) -> list[tuple[tuple[int, ...], int]]:
    """How often to use each pattern; counts[c] pieces are of class c (from 1).

    ``exact`` says that a class holds one length only.
    """
    total = len(counts) - 1
    # Lengths are below their class, by half of one on average, so classes may sum to
    # one too many: the last piece is chosen by its exact length.
    fill = total if exact else total + 1
    all_patterns = [(total,), *(p for p in patterns(fill, most) if p[0] < total or 1 < len(p))]
    all_patterns = [p for p in all_patterns if p[0] <= total]
    matrix = np.zeros((total, len(all_patterns)))
    for j, pattern in enumerate(all_patterns):
        for c in pattern:
            matrix[c - 1, j] += 1
    scale = max(1.0, float(counts.max(initial=0)))
    fitted = nnls(matrix, counts[1:] / scale) * scale
    left = counts.copy()
    out = []
    for j in np.argsort(-fitted, kind="stable"):
        pattern = all_patterns[j]
        need = np.bincount(pattern, minlength=total + 1)
        most_now = int(np.min(left[need > 0] // need[need > 0]))
        repeat = min(int(fitted[j] + 1e-6), most_now)
        if repeat > 0:
            left -= repeat * need
            out.append((pattern, repeat))
    return out


class _Pools:
    """Pieces of each length, given out in runs of equal length."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.given = np.zeros_like(self.left)

    def take(self, length: int, n: int) -> int:
        """Rank of the first of ``n`` pieces."""
        rank = int(self.given[length])
        self.left[length] -= n
        self.given[length] += n
        return rank


def plan(histogram: dict[int, int], limit: int) -> np.ndarray:
    """Rows (length, first rank, pieces, first sequence, offset).

    Pieces of a length with the ranks from the first on go to as many consecutive
    sequences, one each, at the offset.  The number of rows depends on the histogram's
    shape, not on the counts.
    """
    counts = np.zeros(limit + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    classes = min(CLASSES, limit)
    unit = -(-limit // classes)
    classes = -(-limit // unit)
    of = -(-np.arange(limit + 1) // unit)
    by_class = np.bincount(of, counts, minlength=classes + 1).astype(np.int64)
    repeats = pattern_repeats(by_class, PIECES_PER_PATTERN, exact=unit == 1)
    least = -(-int(counts @ np.arange(limit + 1)) // limit)
    best, fewest = None, None
    for share in SHARES:
        parts = [(pattern, int(n * share)) for pattern, n in repeats]
        rows, sequences = _rows(counts, limit, unit, [x for x in parts if x[1]])
        if fewest is None or sequences < fewest:
            best, fewest = rows, sequences
        if fewest == least:
            break
    if not best:
        return np.zeros((0, 5), np.int64)
    table = np.array(best, np.int64)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def _rows(
    counts: np.ndarray, limit: int, unit: int, repeats: list[tuple[tuple[int, ...], int]]
) -> tuple[list[tuple[int, ...]], int]:
    """The plan's rows in any order, and its sequences: the patterns, then best fit."""
    pools, rows, sequences = _Pools(counts), [], 0
    # Groups of equal open sequences: room left, first sequence, how many.
    opened: list[tuple[int, int, int]] = []
    for pattern, repeat in repeats:
        groups = [(0, sequences, repeat)]  # filled, first sequence, how many
        sequences += repeat
        for c in pattern[:-1] if len(pattern) > 1 else pattern:
            after = []
            length = min(c * unit, limit)
            for filled, first, n in sorted(groups):
                while n:
                    while not pools.left[length]:
                        length -= 1
                    m = int(min(n, pools.left[length]))
                    rows.append((length, pools.take(length, m), m, first, filled))
                    after.append((filled + length, first, m))
                    first, n = first + m, n - m
            groups = after
        opened += [(limit - filled, first, n) for filled, first, n in groups if filled < limit]
    room: dict[int, list[tuple[int, int]]] = {}
    for free, first, n in opened:
        room.setdefault(free, []).append((first, n))
    frees = sorted(room)
    for length in range(limit, 0, -1):
        n = int(pools.left[length])
        while n:
            at = bisect_left(frees, length)
            if at < len(frees):
                free = frees[at]
                first, have = heapq.heappop(room[free])
                m = min(n, have)
                if have > m:
                    heapq.heappush(room[free], (first + m, have - m))
                elif not room[free]:
                    del room[free], frees[at]
            else:
                free, m = limit, n if 2 * length > limit else -(-n // (limit // length))
                first, sequences = sequences, sequences + m
            rows.append((length, pools.take(length, m), m, first, limit - free))
            n -= m
            if free > length:
                if free - length not in room:
                    room[free - length] = []
                    insort(frees, free - length)
                heapq.heappush(room[free - length], (first, m))
    return rows, sequences


def _place(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = (table[:, 0] << 44) + table[:, 1]
    for batch in batches:
        length, rank = (batch.column(i).to_numpy() for i in (3, 5))
        row = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
        columns = batch.columns[:5]
        columns += [pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])]
        names = [*batch.schema.names[:5], "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def pack(
    docs: DataFrame, tokenizer: str, last_id: int, limit: int, folder: str | None = None
) -> DataFrame:
    """Pack all documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null text is empty and holds the last id alone.  Repeated rows are packed as
    often as they are given.  An empty table packs nothing.  Other columns are ignored.

    Pieces are encoded once, into a shared table.  Only the histogram, at most ``limit``
    rows, and the plan made from it, go through the driver.  Ranks are counted within
    salted groups, so a length that a third of all pieces have is not one task's.
    """
    spark = docs.sparkSession
    pieces = stage(token_pieces(docs, tokenizer, last_id, limit), "pieces", folder)
    counted = pieces.groupBy("length").count().collect()
    table = plan({r["length"]: r["count"] for r in counted}, limit)
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int")
    salted = pieces.withColumn("salt", salt)
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("salt")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    bases = groups.select("length", "salt", base.alias("base"))
    within = Window.partitionBy("length", "salt")
    within = within.orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("within", F.row_number().over(within) - 1)
    ranked = ranked.join(bases, ["length", "salt"]).select(
        *PIECES_COLUMNS, (F.col("within") + F.col("base")).alias("rank")
    )
    schema = f"{PIECES}, sequence_id long, offset long"
    return ranked.mapInArrow(partial(_place, table=table), schema)


PIECES_COLUMNS = [x.split()[0] for x in PIECES.split(", ")]
