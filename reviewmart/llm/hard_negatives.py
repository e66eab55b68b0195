"""Hard negatives by inner product, with segment summaries as a filter.

A vector is cut into segments, and each one's mean and deviation (the root of its summed
squares about the mean) is kept.  Over a segment of n components the inner product of two
vectors is n times their means' product, give or take the product of their deviations.
Summed over segments, that bounds a score from both sides.  A pair that the bounds of few
long segments cannot settle is judged by more and shorter ones, level by level, and what
is left is scored exactly.  As sums of products, the bounds of all pairs of two blocks are
two matrix products.

Anchors are dealt to chunks of bounded size.  Every task has a chunk and streams its part
of all rows by; it keeps only what can still be among an anchor's first rows, so the bounds
it tests against get tighter as it goes.  The tasks' few rows are then ranked.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmart.llm.tasks import ship, stage

# Anchors, and components of theirs, in a chunk, about; anchors and rows whose scores are
# in memory together.
CHUNK, CHUNK_VALUES, ANCHORS, ROWS = 1 << 13, 1 << 20, 1 << 7, 1 << 12
# Segments that a segment is refined to, and the shortest that is still summarized.
SPLIT, SHORTEST = 4, 4
# Pairs of one block that are scored one by one; more are scored as a matrix.
FEW = 1 / 16
# Below it, sums of products are exact in doubles.
EXACT = 2.0**53


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Lists of integers as rows; short ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


class Summaries:
    """Vectors with their segments' scaled means and deviations, coarse level first."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.values = vectors.astype(np.float64)
        self.largest = float(np.abs(self.values).max(initial=0))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        size = vectors.shape[1]
        while size >= SHORTEST:
            self.levels.append(self._level(size))
            size = -(-size // SPLIT)

    def _level(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Means times the root of the segment's length, and deviations, by segment."""
        width = self.values.shape[1]
        starts = np.arange(0, width, size)
        lengths = np.minimum(starts + size, width) - starts
        means = np.add.reduceat(self.values, starts, axis=1) / lengths
        about = self.values - np.repeat(means, lengths, axis=1)
        deviations = np.sqrt(np.add.reduceat(about * about, starts, axis=1))
        return means * np.sqrt(lengths), deviations

    def of(self, rows: np.ndarray | slice) -> Summaries:
        part = object.__new__(Summaries)
        part.vectors, part.values, part.largest = self.vectors[rows], self.values[rows], self.largest
        part.levels = [(m[rows], d[rows]) for m, d in self.levels]
        return part


def bounds(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], pairs=None):
    """(least, most) that scores can be: of all pairs, or of these (rows of a, rows of b)."""
    if pairs is None:
        middle, spread = a[0] @ b[0].T, a[1] @ b[1].T
    else:
        middle, spread = (np.einsum("ij,ij->i", x[pairs[0]], y[pairs[1]]) for x, y in zip(a, b, strict=True))
    # Scores are whole numbers: half of one is more than rounding can take.
    spread = spread + 0.5 + 1e-9 * (np.abs(middle) + spread)
    return middle - spread, middle + spread


def scores(a: Summaries, b: Summaries, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact integer inner products of these pairs."""
    all_pairs = len(a.vectors) * len(b.vectors)
    if len(pairs[0]) > FEW * all_pairs and a.largest * b.largest * a.vectors.shape[1] < EXACT:
        return (a.values @ b.values.T)[pairs].astype(np.int64)
    out = np.empty(len(pairs[0]), np.int64)
    for low in range(0, len(out), 1 << 16):
        own = slice(low, low + (1 << 16))
        out[own] = np.einsum("ij,ij->i", a.vectors[pairs[0][own]], b.vectors[pairs[1][own]])
    return out


def open_pairs(a: Summaries, b: Summaries, least: np.ndarray, most: np.ndarray, allowed: np.ndarray):
    """Allowed pairs whose score may be from ``least`` to ``most`` of its row of a."""
    pairs = None
    for x, y in zip(a.levels, b.levels, strict=True):
        low, high = bounds(x, y, pairs)
        if pairs is None:
            kept = allowed & (high >= least[:, None]) & (low <= most[:, None])
            if kept.sum() > FEW * kept.size:
                allowed = kept  # many: the next level is a matrix as well
            else:
                pairs = np.nonzero(kept)
        else:
            kept = (high >= least[pairs[0]]) & (low <= most[pairs[0]])
            pairs = (pairs[0][kept], pairs[1][kept])
    return np.nonzero(allowed) if pairs is None else pairs


class Best:
    """For every list, the k rows of highest score so far, ties to the smaller id."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.of = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)
        # A list's last score once it is full.
        self.needed = np.full(lists, -np.inf)

    def add(self, of: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        open_ = scores >= self.needed[of]
        if not open_.any():
            return
        new = (of[open_], ids[open_], scores[open_])
        of, ids, scores = (np.concatenate(x) for x in zip((self.of, self.ids, self.scores), new, strict=True))
        order = np.lexsort((ids, -scores, of))
        of, ids, scores = of[order], ids[order], scores[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        kept = place < self.k
        self.of, self.ids, self.scores = of[kept], ids[kept], scores[kept]
        full = place == self.k - 1
        self.needed[of[full]] = scores[full]


class Chunk:
    """Some anchors, and for the second pass the score range of each of their positives."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.vectors = vectors

    def summaries(self, width: int) -> Summaries:
        """Both sides need one width; rows of another length than the chunk's are rare."""
        if not hasattr(self, "_made") or self._made.vectors.shape[1] != width:
            vectors = np.zeros((len(self.vectors), width), np.int64)
            vectors[:, : self.vectors.shape[1]] = self.vectors
            self._made = Summaries(vectors)
        return self._made

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(ids, labels, vectors) of at most ROWS rows, whatever the batches' sizes."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            take = batch.slice(0, ROWS - rows)
            batch = batch.slice(take.num_rows)
            held.append(take)
            rows += take.num_rows
            if rows == ROWS:
                yield _block(held)
                held, rows = [], 0
    if rows:
        yield _block(held)


def _block(held: list[pa.RecordBatch]) -> tuple:
    table = pa.Table.from_batches(held).combine_chunks()
    ids, labels, vectors = (table.column(i).chunk(0) for i in range(3))
    return ids.to_numpy(), labels.to_numpy(), matrix(vectors)


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


FOUND = "list long, vec_id long, score long"


def _rows(best: Best) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(best.of), 1 << 16):
        own = slice(low, low + (1 << 16))
        columns = [pa.array(x[own]) for x in (best.of, best.ids, best.scores)]
        yield pa.RecordBatch.from_arrays(columns, names=["list", "vec_id", "score"])


def _positives(batches: Iterator[pa.RecordBatch], chunk: Chunk, k: int) -> Iterator[pa.RecordBatch]:
    """A task's first k other rows of each anchor's label; a list is an anchor's place."""
    best = Best(len(chunk.ids), k)
    for ids, labels, vectors in _blocks(batches):
        width = max(vectors.shape[1], chunk.vectors.shape[1])
        anchors, rows = chunk.summaries(width), Summaries(_wide(vectors, width))
        for label in np.intersect1d(labels, chunk.labels):
            same = np.flatnonzero(labels == label)
            asking = np.flatnonzero(chunk.labels == label)
            some = rows.of(same)
            for low in range(0, len(asking), ANCHORS):
                own = asking[low : low + ANCHORS]
                part = anchors.of(own)
                other = chunk.ids[own][:, None] != ids[same]
                a, b = open_pairs(part, some, best.needed[own], np.full(len(own), np.inf), other)
                best.add(own[a], ids[same][b], scores(part, some, (a, b)))
    yield from _rows(best)


def _negatives(
    batches: Iterator[pa.RecordBatch],
    chunk: Chunk,
    list_anchor: np.ndarray,
    floor: np.ndarray,
    ceiling: np.ndarray,
    k: int,
) -> Iterator[pa.RecordBatch]:
    """A task's first k rows of each list: of another label, scores from floor to ceiling.

    Lists of one anchor follow each other.
    """
    best = Best(len(list_anchor), k)
    first = np.searchsorted(list_anchor, np.arange(len(chunk.ids) + 1))
    asking = np.flatnonzero(np.diff(first))
    for ids, labels, vectors in _blocks(batches):
        width = max(vectors.shape[1], chunk.vectors.shape[1])
        anchors, rows = chunk.summaries(width), Summaries(_wide(vectors, width))
        for low in range(0, len(asking), ANCHORS):
            own = asking[low : low + ANCHORS]
            part = anchors.of(own)
            # A row is open if it may be for any of the anchor's lists.
            needed = np.maximum(best.needed, floor)
            least = np.minimum.reduceat(needed, first[own])[: len(own)]
            most = np.maximum.reduceat(ceiling, first[own])[: len(own)]
            if own[-1] + 1 < len(first) - 1:
                # The last reduction went on beyond the last anchor's lists.
                least[-1] = needed[first[own[-1]] : first[own[-1] + 1]].min()
                most[-1] = ceiling[first[own[-1]] : first[own[-1] + 1]].max()
            differ = chunk.labels[own][:, None] != labels
            differ &= chunk.ids[own][:, None] != ids
            a, b = open_pairs(part, rows, least, most, differ)
            found = scores(part, rows, (a, b))
            anchor = own[a]
            for j in range(int(np.diff(first)[own].max(initial=0))):
                of = first[anchor] + j
                has = of < first[anchor + 1]
                of, score, row = of[has], found[has], b[has]
                inside = (score >= floor[of]) & (score <= ceiling[of])
                best.add(of[inside], ids[row[inside]], score[inside])
    yield from _rows(best)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each list, with their rank."""
    order = Window.partitionBy("list").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def score_range(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with low * p <= 100 * s <= high * p, as (least, most)."""
    def part(percent: int, x: np.ndarray) -> np.ndarray:
        return percent * (x // 100) + percent * (x % 100) // 100

    return -part(low, -positive), part(high, positive)


def mine(
    anchors: DataFrame,
    rows: DataFrame,
    n_positives: int,
    n_negatives: int,
    low_percent: int,
    high_percent: int,
    folder: str | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Both tables are (vec_id long, label long, vector array<long>); ``anchors`` are asked
    about, ``rows`` are all that answer.  Scores are integer inner products, higher ones
    first, ties to the smaller id.  An anchor's positives are its first ``n_positives`` rows
    of the same label; a row of the anchor's own id is no other row.  For each of them, the
    negatives are the first ``n_negatives`` rows of another label with a score from
    ``low_percent`` to ``high_percent`` of the positive's, so a negative positive score has none.

    Rows with a null id, label or vector, or a null component, take no part.  Vectors of
    several lengths are compared as if the short ones ended in zeros.  Repeated rows count
    as many rows; each repeated anchor has its own results.  Empty tables give none.  Sums
    must fit 64 bits.

    Every anchor is compared with every row, by bounds first: the anchors go to tasks in
    chunks of about CHUNK rows or CHUNK_VALUES components, which is all that is ever on the
    driver or sent to all tasks.
    """
    spark = rows.sparkSession
    ship(spark)
    sides = []
    for side in (anchors, rows):
        side = side.selectExpr("CAST(vec_id AS LONG) vec_id", "CAST(label AS LONG) label", "CAST(vector AS ARRAY<LONG>) vector")
        sides.append(side.where("vec_id IS NOT NULL AND label IS NOT NULL AND NOT exists(vector, v -> v IS NULL)"))
    asking, answering = sides
    # A row's number deals it out, as one id may have many rows.
    asking = stage(asking.withColumn("number", F.monotonically_increasing_id()), "anchors", folder)
    size = asking.agg(F.count("*"), F.sum(F.size("vector"))).first()
    chunks = max(-(-size[0] // CHUNK), -(-(size[1] or 0) // CHUNK_VALUES), 1)
    dealt = asking.withColumn("chunk", F.pmod(F.xxhash64("number"), F.lit(chunks)))
    out = None
    for i in range(chunks):
        table = dealt.where(F.col("chunk") == i).orderBy("number").drop("number", "chunk").toArrow()
        table = table.combine_chunks()
        if not table.num_rows:
            continue
        ids, labels, vectors = (table.column(c).chunk(0) for c in ("vec_id", "label", "vector"))
        chunk = Chunk(ids.to_numpy(), labels.to_numpy(), matrix(vectors))
        part = _chunk(answering, chunk, n_positives, n_negatives, (low_percent, high_percent))
        part = stage(part, f"hard-negatives-{i}", folder)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], RESULT) if out is None else out


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def _chunk(
    rows: DataFrame, chunk: Chunk, n_positives: int, n_negatives: int, percent: Sequence[int]
) -> DataFrame:
    spark = rows.sparkSession
    near = rows.mapInArrow(partial(_positives, chunk=chunk, k=n_positives), FOUND)
    # A few rows for each anchor of the chunk.
    near = _first(near, n_positives).orderBy("list", "rank").toArrow()
    anchor, positive, score = (np.array(near.column(c).combine_chunks()) for c in ("list", "vec_id", "score"))
    floor, ceiling = score_range(score, *percent)
    work = partial(
        _negatives, chunk=chunk, list_anchor=anchor, floor=floor, ceiling=ceiling, k=n_negatives
    )
    far = _first(rows.mapInArrow(work, FOUND), n_negatives)
    lists = pa.table({
        "list": np.arange(len(anchor)),
        "anchor_id": chunk.ids[anchor],
        "positive_id": positive,
        "positive_score": score,
    })
    far = far.join(spark.createDataFrame(lists), "list")
    return far.selectExpr(
        "anchor_id", "positive_id", "rank", "vec_id negative_id", "positive_score", "score negative_score"
    )
