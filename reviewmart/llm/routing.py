"""Finding keys that occur more than once, among many more that do not.

Rows are dealt to tasks by key and stream through in order of key, so a task holds no
group.  A key that one chunk of texts holds many times is known to be repeated: only
its first row there goes by key, the others are dealt out by their content.  So a key
that a third of all rows have costs its task no more than a row for each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ONCE, FIRST, AGAIN = 0, 1, 2


def flags(keys: np.ndarray) -> np.ndarray:
    """For one chunk's keys: alone, first of several, or a later one."""
    order = np.argsort(keys, kind="stable")
    own = keys[order]
    later = np.zeros(len(own), bool)
    later[1:] = own[1:] == own[:-1]
    first = np.zeros(len(own), bool)
    first[:-1] = later[1:] & ~later[:-1]
    out = np.zeros(len(keys), np.int8)
    out[order] = np.where(later, AGAIN, np.where(first, FIRST, ONCE))
    return out


def _keep(
    batches: Iterator[pa.RecordBatch], choose: Callable | None
) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    last = None

    def repeated(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, flag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        known = np.zeros(len(size), bool)
        known[group[flag > ONCE]] = True
        at = np.flatnonzero((known | (size > 1))[group])
        if choose and len(at):
            at = np.sort(at[choose(batch.take(pa.array(at)), group[at], known[group[at]])])
        return batch.take(pa.array(at)).drop_columns(["flag"])

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        # The group that the batch ends in may go on in the next one.
        cut = int(np.searchsorted(key, key[-1]))
        if key[-1] == last and cut == 0:
            held.append(batch)
            continue
        held.append(batch.slice(0, cut))
        whole = [b for b in held if b.num_rows]
        if whole:
            held = whole
            yield repeated(joined())
        held, last = [batch.slice(cut)], key[-1]
    if held:
        yield repeated(joined())


def repeated(rows: DataFrame, choose: Callable | None = None) -> DataFrame:
    """The rows of (key long, flag byte, ...) whose key occurs again, without the flag.

    ``flag`` is what :func:`flags` says.  Rows that only seem repeated are never kept.
    ``choose(rows, group, known)`` may leave some out: it gets rows of whole groups, and
    returns places of those that stay.  A group that is ``known`` to be repeated may have
    more rows in other tasks.
    """
    rest = [c for c in rows.columns if c not in ("key", "flag")]
    place = F.when(F.col("flag") == AGAIN, F.xxhash64("key", *rest)).otherwise(F.col("key"))
    dealt = rows.select("key", "flag", *rest).repartition(place).sortWithinPartitions("key")
    schema = rows.select("key", *rest).schema
    return dealt.mapInArrow(partial(_keep, choose=choose), schema)
