"""Windows of a text that occur again: how they meet, whatever index then compares them.

Equal windows must meet in one shard, however many texts there are.  A window's key is
the least hash of the short runs of symbols in it, so equal windows have equal keys, and
neighbouring windows mostly share theirs: consecutive windows that have it at the same
place are cut out together as a *piece*.  Each window is in exactly one piece, and no
piece holds equal windows, as they have their least run at the same distance.

1. pieces whose key occurs once are dropped: no window of theirs occurs again;
2. equal pieces become one, with their number and first place;
3. the texts of the distinct pieces are cut out, and dealt to shards by key;
4. a shard's index says of each piece which of its windows occur again;
5. that goes back to all places of the piece.

A key with too many pieces for a shard (a passage that many texts hold, each with other
words around it) is taken apart: its windows become pieces of their own, keyed by their
whole content, and step 1 drops those that are alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.routing import flags, repeated
from reviewmart.llm.tasks import (
    MIX,
    chunks,
    mixed,
    rolled,
    ship,
    sliding_min,
    span_hashes,
    stage,
    utf8,
    word_bounds,
)
from reviewmart.llm.texts import unzipped, zipped

PIECES = "key long, flag byte, h long, doc_id long, start int, m int"


@dataclass(frozen=True)
class Windows:
    """``length`` symbols each, keyed by runs of ``run`` symbols; a shard's index holds
    some ``shard`` symbols."""

    words: bool
    length: int
    run: int
    shard: int

    def symbols(self, data: np.ndarray, offsets: np.ndarray):
        """Each symbol's hash, start and end, and the symbols before each text."""
        if self.words:
            starts, ends, at = word_bounds(data, offsets)
            return span_hashes(data, starts, ends), starts, ends, at
        every = np.arange(len(data))
        return mixed(data + np.uint64(1)), every, every + 1, offsets


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _content(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of symbols, from sums of all before it."""
    n = len(h)
    power = np.full(n + 1, MIX)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(n + 1, np.uint64(_inverse(int(MIX))))
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:n], dtype=np.uint64)])
    return mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def cut_pieces(h: np.ndarray, at: np.ndarray, w: Windows):
    """Text, start, number of windows, key and content hash of every piece."""
    size = np.diff(at)
    if len(h) < w.length:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    runs = rolled(h, w.run)
    keys = sliding_min(runs, w.length - w.run + 1)
    text = np.repeat(np.arange(len(size)), size)
    first, last = text[: len(keys)], text[w.length - 1 :]
    inside = first == last
    # A piece ends where the least run's place changes, even to an equal one.
    moved = (keys[1:] != keys[:-1]) | (runs[: len(keys) - 1] == keys[:-1])
    new = inside.copy()
    new[1:] &= moved | (first[1:] != first[:-1]) | ~inside[:-1]
    begin = np.flatnonzero(new)
    stop = np.append(np.flatnonzero(new[1:] | ~inside[1:]) + 1, len(keys))
    m = stop[np.searchsorted(stop, begin, "right")] - begin
    content = _content(h, begin, begin + m + w.length - 1)
    return first[begin], begin - at[first[begin]], m, keys[begin], content


def _rows(doc_ids: pa.Array, text, start, m, key, content) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)),
            pa.array(flags(key)),
            pa.array(content.view(np.int64)),
            doc_ids.take(pa.array(text)),
            pa.array(start.astype(np.int32)),
            pa.array(m.astype(np.int32)),
        ],
        names=["key", "flag", "h", "doc_id", "start", "m"],
    )


def _pieces(batches: Iterator[pa.RecordBatch], w: Windows) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in chunks(batch):
            h, _, _, at = w.symbols(data, offsets)
            out = _rows(rows.column(0), *cut_pieces(h, at, w))
            for low in range(0, out.num_rows, 1 << 16):
                yield out.slice(low, 1 << 16)


def _single(batches: Iterator[pa.RecordBatch], w: Windows) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, z, places) with places [(start, m)]: each window, keyed by content."""
    for whole in batches:
        for low in range(0, whole.num_rows, 64):
            batch = whole.slice(low, 64)
            data, offsets = utf8(unzipped(batch.column(1))[1])
            h, _, _, at = w.symbols(data, offsets)
            keys = rolled(h, w.length)
            text, start = [], []
            for i, places in enumerate(batch.column(2).to_pylist()):
                for p in places:
                    own = np.arange(p["start"], p["start"] + p["m"])
                    start.append(own)
                    text.append(np.full(len(own), i))
            text, start = np.concatenate(text), np.concatenate(start)
            key = keys[at[text] + start]
            one = np.ones(len(key), np.int64)
            yield _rows(batch.column(0), text, start, one, key, mixed(key))


def _contents(batches: Iterator[pa.RecordBatch], w: Windows) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, z, pieces): each piece's own symbols, words joined by a space."""
    for whole in batches:
        for low in range(0, whole.num_rows, 64):
            batch = whole.slice(low, 64)
            data, offsets = utf8(unzipped(batch.column(1))[1])
            _, begins, ends, at = w.symbols(data, offsets)
            raw = data.tobytes()
            out: list[tuple] = []
            for i, pieces in enumerate(batch.column(2).to_pylist()):
                doc = batch.column(0)[i].as_py()
                for p in pieces:
                    a = at[i] + p["start"]
                    b = a + p["m"] + w.length - 1
                    content = raw[begins[a] : ends[b - 1]]
                    if w.words:
                        content = b" ".join(content.split())
                    out.append((p["key"], p["h"], p["n"], doc, p["start"], p["m"], content))
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
            names = ["key", "h", "n", "doc_id", "start", "m", "content"]
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _judged(table: pa.Table, judge: Callable, w: Windows) -> pa.Table:
    columns = {x: table.column(x).to_numpy() for x in ("n", "doc_id", "start", "m")}
    contents = table.column("content").to_pylist()
    at_first, elsewhere = judge(contents, **columns, w=w)
    schema = pa.schema(
        [("key", pa.int64()), ("h", pa.int64()), ("doc1", pa.int64()), ("start1", pa.int32()),
         ("at_first", pa.binary()), ("elsewhere", pa.binary())]
    )
    out = pa.Table.from_arrays(
        [
            *(table.column(x) for x in ("key", "h", "doc_id", "start")),
            pa.array(at_first, pa.binary()),
            pa.array(elsewhere, pa.binary()),
        ],
        schema=schema,
    )
    some = [bool(a.strip(b"\0")) or bool(b.strip(b"\0")) for a, b in zip(at_first, elsewhere, strict=True)]
    return out.filter(pa.array(some, pa.bool_()))


def unique_ids(docs: DataFrame, folder: str | None) -> tuple[DataFrame, bool]:
    """(doc_id, text) with a number of its own for each row if ids are null or repeated.

    Numbers follow (doc_id, text), null ids first; ``real_id`` then has the id.
    """
    again = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if again.isEmpty():
        return docs, False
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    numbered = ordered.select(
        F.monotonically_increasing_id().alias("doc_id"), "text", F.col("doc_id").alias("real_id")
    )
    return stage(numbered, "numbered", folder), True


def repeated_windows(
    docs: DataFrame, w: Windows, judge: Callable, folder: str | None = None
) -> DataFrame:
    """(doc_id, places): per text, [(start, hits)] of its windows that are to go.

    ``hits`` has a bit for each window from ``start`` on.  ``judge`` gets a shard's
    distinct pieces and says, in bits, which windows go at a piece's first place and
    which at its others.  ``doc_id`` must be unique.
    """
    spark = docs.sparkSession
    ship(spark)
    found = repeated(docs.mapInArrow(partial(_pieces, w=w), PIECES))
    found = stage(found, "pieces", folder)
    z = zipped(docs)

    def distinct(pieces: DataFrame) -> DataFrame:
        first = F.min(F.struct("doc_id", "start")).alias("first")
        return pieces.groupBy("key", "h").agg(F.count("*").alias("n"), first, F.first("m").alias("m"))

    pieces = stage(distinct(found), "distinct", folder)
    size = F.col("m") + (w.length - 1)
    hot = pieces.groupBy("key").agg(F.sum(size).alias("s")).where(F.col("s") > w.shard).select("key")
    hot = stage(hot, "hot-keys", folder)
    if not hot.isEmpty():
        places = found.join(hot, "key", "semi").groupBy("doc_id")
        places = places.agg(F.collect_list(F.struct("start", "m")).alias("places"))
        apart = z.join(places, "doc_id").mapInArrow(partial(_single, w=w), PIECES)
        found = found.join(hot, "key", "anti").select("key", "h", "doc_id", "start", "m")
        found = stage(found.union(repeated(apart)), "pieces-apart", folder)
        pieces = stage(distinct(found), "distinct-apart", folder)

    wanted = pieces.select(
        F.col("first.doc_id").alias("doc_id"),
        F.struct("key", "h", "n", F.col("first.start").alias("start"), "m").alias("p"),
    )
    wanted = wanted.groupBy("doc_id").agg(F.collect_list("p").alias("pieces"))
    contents = z.join(wanted, "doc_id").mapInArrow(
        partial(_contents, w=w),
        "key long, h long, n long, doc_id long, start int, m int, content binary",
    )
    symbols = pieces.agg(F.sum(size)).first()[0] or 0
    shards = int(max(-(-symbols // w.shard), 1))
    sharded = contents.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    apply = partial(_judged, judge=judge, w=w)

    def of_shard(table: pa.Table) -> pa.Table:
        return apply(table)

    verdict = sharded.groupBy("shard").applyInArrow(
        of_shard,
        "key long, h long, doc1 long, start1 int, at_first binary, elsewhere binary",
    )
    verdict = stage(verdict, "verdict", folder)
    is_first = (F.col("doc_id") == F.col("doc1")) & (F.col("start") == F.col("start1"))
    hits = F.when(is_first, F.col("at_first")).otherwise(F.col("elsewhere"))
    back = found.join(verdict, ["key", "h"]).select("doc_id", F.struct("start", hits.alias("hits")).alias("p"))
    return back.groupBy("doc_id").agg(F.collect_list("p").alias("places"))


def covered(places: list[dict] | None, n: int, length: int) -> np.ndarray:
    """Which of a text's ``n`` symbols lie in a window that is to go."""
    change = np.zeros(n + 1, np.int64)
    for p in places or ():
        at = p["start"] + np.flatnonzero(np.unpackbits(np.frombuffer(p["hits"], np.uint8)))
        change[at] += 1
        change[at + length] -= 1
    return np.cumsum(change[:n]) > 0
