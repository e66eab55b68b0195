"""Exact top-k by inner product, term at a time.

Candidates are stored in blocks, each as posting lists: for every term the candidates
that have it and their weights.  A block of sparse query rows meets a block of
candidates in one task.  Each term of a query scatters its weighted posting list into
the query's row of a dense score array; partition selection keeps the k best of the
block, and the blocks' bests are merged.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmart.llm.tasks import ship, stage

CANDIDATES = 1 << 12
QUERIES = 1 << 8
HITS = "query_id long, asked_in long, place int, vec_id long, score long"


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Ids, row, term and weight of every entry."""
    terms, weights = batch.column(1), batch.column(2)
    sizes = np.diff(terms.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), sizes)
    return (
        batch.column(0).to_numpy(),
        row,
        terms.flatten().to_numpy(),
        weights.flatten().to_numpy(),
    )


def _blocks(batches: Iterator[pa.RecordBatch], size: int, by_term: bool):
    """Blocks of at most ``size`` vectors as one binary each; entries by term or by row."""
    held, rows = [], 0

    def done(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, row, term, weight = _sparse(batch)
        # A term that a vector names twice counts with the sum of its weights.
        order = np.lexsort((row, term) if by_term else (term, row))
        row, term, weight = row[order], term[order], weight[order]
        if len(row):
            new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(term, prepend=0) != 0))
            new = np.union1d(new, [0]).astype(np.int64)
            row, term, weight = row[new], term[new], np.add.reduceat(weight, new)
        block = pickle.dumps((ids, row.astype(np.int32), term, weight), protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

    for batch in batches:
        while batch.num_rows:
            take = batch.slice(0, size - rows)
            held.append(take)
            rows += take.num_rows
            batch = batch.slice(take.num_rows)
            if rows == size:
                yield done(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, rows = [], 0
    if rows:
        yield done(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    ties = np.flatnonzero(scores == least)
    room = k - len(above)
    if len(ties) > room:
        ties = ties[np.argpartition(ids[ties], room - 1)[:room]]
    return np.concatenate([above, ties])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    last, lists = None, {}
    for batch in batches:
        for queries, asked_in, candidates in zip(*batch.columns, strict=True):
            candidates = candidates.as_py()
            if candidates != last:
                last = candidates
                ids, row, term, weight = pickle.loads(candidates)
                cuts = np.flatnonzero(np.diff(term)) + 1
                begins = np.concatenate([[0], cuts]).astype(np.int64)[: len(term)]
                ends = np.concatenate([cuts, [len(term)]])
                lists = {
                    int(term[a]): (row[a:b], weight[a:b]) for a, b in zip(begins, ends, strict=False)
                }
            q_ids, q_row, q_term, q_weight = pickle.loads(queries.as_py())
            cuts = np.searchsorted(q_row, np.arange(len(q_ids) + 1))
            out: list[tuple] = []
            scores = np.empty(len(ids), np.int64)
            for q, query in enumerate(q_ids):
                scores[:] = 0
                for i in range(cuts[q], cuts[q + 1]):
                    postings = lists.get(int(q_term[i]))
                    if postings is None:
                        continue
                    at, weights = postings
                    if len(at) == len(scores):  # every candidate, in order
                        scores += weights * q_weight[i]
                    else:
                        scores[at] += weights * q_weight[i]
                others = np.flatnonzero(ids != query)
                best = others[_best(scores[others], ids[others], k)]
                same = [np.full(len(best), x) for x in (query, asked_in.as_py(), q)]
                out.append((*same, ids[best], scores[best]))
            names = [x.split()[0] for x in HITS.split(", ")]
            kinds = [pa.int32() if x == "place" else pa.int64() for x in names]
            columns = [
                pa.array(np.concatenate(x), k)
                for x, k in zip(zip(*out, strict=True), kinds, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int, folder: str | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k candidates of highest integer inner product.

    Both tables are (vec_id long, terms array<long>, weights array<long>), terms and
    weights of one vector alike in number.  A candidate with the query's own id is left
    out; ties go to the smaller id; a query with fewer candidates gets them all, also
    those that share no term with it (score 0).  Rows with a null id, or a null among
    their terms or weights, take no part.  Repeated rows are as many candidates, and
    as many queries: each has its own k ranks, under the same ``query_id``.  Empty
    tables give an empty result.  Sums must fit 64 bits.

    Exact search compares every query with every candidate: each block of 256 queries
    meets each block of 4096 candidates once.  Blocks are paired, never rows.
    """
    spark = queries.sparkSession
    ship(spark)
    sides = []
    for side, size, by_term in ((queries, QUERIES, False), (candidates, CANDIDATES, True)):
        whole = [f"{x} IS NOT NULL AND NOT exists({x}, v -> v IS NULL)" for x in ("terms", "weights")]
        side = side.selectExpr(
            "CAST(vec_id AS LONG) vec_id",
            "CAST(terms AS ARRAY<LONG>) terms",
            "CAST(weights AS ARRAY<LONG>) weights",
        ).where(" AND ".join(["vec_id IS NOT NULL", *whole]))
        blocks = side.mapInArrow(partial(_blocks, size=size, by_term=by_term), "block binary")
        blocks = blocks.withColumn("asked_in", F.monotonically_increasing_id())
        # Written once: a block must hold the same rows whoever reads it again.
        sides.append(stage(blocks, f"topk-{'candidates' if by_term else 'queries'}", folder))
    asked, held = sides
    pairs = asked.withColumnRenamed("block", "asked").crossJoin(held.select("block"))
    hits = pairs.select("asked", "asked_in", "block").mapInArrow(partial(_search, k=k), HITS)
    # One query row is known by its block and its place there, not by its id.
    query = Window.partitionBy("query_id", "asked_in", "place")
    order = query.orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
