"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is of the bytes of texts: every run of ORDER bytes, with SEPARATOR before a
text and after it, packs into one 64-bit number, so counts need no vocabulary and no
text fails to be scored.  Counts come from all trusted texts.

Nothing here grows on the driver.  A task counts the n-grams of its texts, and counts
are summed by n-gram; lower orders count distinct left neighbours (continuations).
Scoring splits documents into blocks; every block's distinct n-grams are joined with the
sharded counts, order by order, and their log probabilities go back to the block.  Few
n-grams are new in a block, so that moves far less than one row per byte.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.tasks import chunks, give_back, ship, stage, utf8

ORDER = 5
SEPARATOR = 0
SYMBOLS = 256
BLOCK_BYTES = 32 << 20
# One in FOLDS trusted texts is kept from training; thresholds rest on these.
FOLDS = 5
# A text is rejected if it lies so many interquartile ranges above the upper quartile.
FENCE = 3.0
# A language with fewer held-out texts is judged by those of all languages.
MIN_HELD_OUT = 20
# Ids of trusted texts that may be broadcast, 8 bytes each; more are joined by shuffle.
MAX_BROADCAST = 4_000_000


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that end at each byte of each text and at its end; texts' bounds.

    The byte that an n-gram ends with is its lowest; what is before the text is 0.
    """
    n = np.diff(offsets)
    at = offsets + np.arange(len(offsets)) * order
    out = np.zeros(len(data) + order * len(n), np.uint8)
    doc = np.repeat(np.arange(len(n)), n)
    # Each text has order - 1 separators before it and one after it.
    out[np.arange(len(data)) + doc * order + order - 1] = data
    packed = np.zeros(max(len(out) - order + 1, 0), np.int64)
    for j in range(order):
        packed = (packed << 8) | out[j : j + len(packed)]
    ends = np.cumsum(n + 1)
    inside = np.repeat(at[:-1], n + 1) + np.arange(int(ends[-1]) if len(ends) else 0)
    inside -= np.repeat(ends - (n + 1), n + 1)
    return packed[inside], np.concatenate([[0], ends])


def _counted(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """A task's n-grams and how often they occur."""
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for _, data, offsets in chunks(batch, 0):
            new, n = np.unique(_grams(data, offsets, order)[0], return_counts=True)
            both = np.concatenate([grams, new])
            grams, where = np.unique(both, return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, n])).astype(np.int64)
    for low in range(0, len(grams), 1 << 16):
        own = slice(low, low + (1 << 16))
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams[own]), pa.array(counts[own])], names=["gram", "n"]
        )


@dataclass(frozen=True)
class Model:
    """``counts[k]``: (gram, c) of order k + 1, continuation counts below the highest;
    ``contexts[k]``: (context, total, n1, n2, n3) of the same; ``discounts[k]``."""

    counts: Sequence[DataFrame]
    contexts: Sequence[DataFrame]
    discounts: Sequence[tuple[float, float, float]]


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Discounts for counts of 1, 2, and 3 or more (Chen and Goodman).

    Where a count that they rest on does not occur, a plain 0.5 for the count's first
    and what keeps them within 0 and the count for the others.
    """
    n = [counts_of_counts.get(i, 0) for i in range(1, 5)]
    if not n[0] or not n[1]:
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    found = []
    for k in range(1, 4):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5
        found.append(min(max(d, 0.0), float(k)))
    return found[0], found[1], found[2]


def train(texts: DataFrame, folder: str | None = None, order: int = ORDER) -> Model:
    """The model of all texts in the one column ``text``; nulls count as empty.

    Without any text there are no counts, and all bytes are equally likely.
    """
    ship(texts.sparkSession)
    counted = texts.select(F.col("text").cast("string")).mapInArrow(
        partial(_counted, order=order), "gram long, n long"
    )
    level = counted.groupBy("gram").agg(F.sum("n").alias("c"))
    counts, contexts, found = [], [], []
    for k in range(order, 0, -1):
        held = stage(level, f"grams-{k}", folder)
        few = held.where("c <= 4").groupBy("c").count().collect()
        found.append(discounts({r[0]: r[1] for r in few}))
        context = held.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("c").alias("total"),
            F.count_if(F.col("c") == 1).alias("n1"),
            F.count_if(F.col("c") == 2).alias("n2"),
            F.count_if(F.col("c") >= 3).alias("n3"),
        )
        counts.append(held)
        contexts.append(stage(context, f"contexts-{k}", folder))
        # Distinct bytes before the shorter n-gram.
        shorter = F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1)
        level = held.groupBy(shorter.alias("gram")).agg(F.count("*").alias("c"))
    return Model(counts[::-1], contexts[::-1], found[::-1])


def _discount(count: Column, d: tuple[float, float, float]) -> Column:
    return F.when(count == 1, d[0]).when(count == 2, d[1]).otherwise(d[2])


def log_probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """(gram, logp): of the last byte after the others, for distinct highest-order grams.

    p(w | h) = max(c(hw) - D, 0) / c(h) + g(h) p(w | shorter h), from equal chances up.
    A context that was never seen leaves all to the shorter one.
    """
    order = len(model.counts)
    p = grams.select("gram").withColumn("p", F.lit(1.0 / SYMBOLS))
    for k in range(1, order + 1):
        d = model.discounts[k - 1]
        mask = (1 << 8 * k) - 1
        own = F.col("gram").bitwiseAND(mask) if k < 8 else F.col("gram")
        p = p.withColumn("own", own).withColumn("context", F.shiftright(own, 8))
        found = model.counts[k - 1].withColumnRenamed("gram", "own")
        p = p.join(found, "own", "left").join(model.contexts[k - 1], "context", "left")
        seen = F.when(F.col("c").isNull(), 0.0).otherwise(
            F.greatest(F.col("c") - _discount(F.col("c"), d), F.lit(0.0))
        )
        back = F.col("n1") * d[0] + F.col("n2") * d[1] + F.col("n3") * d[2]
        mixed = (seen + back * F.col("p")) / F.col("total")
        p = p.select("gram", F.when(F.col("total").isNull(), F.col("p")).otherwise(mixed).alias("p"))
    return p.select("gram", F.log(F.greatest("p", F.lit(1e-12))).cast("float").alias("logp"))


def _blocks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple]:
    """(block, rows) in order; a block has about BLOCK_BYTES of a task's texts.

    Depends on the rows alone, not on how they come in batches: any reader of the same
    partition finds the same blocks.
    """
    base = TaskContext.get().partitionId() << 32
    before = 0
    for batch in batches:
        _, offsets = utf8(batch.column(text))
        block = (before + offsets[:-1]) // BLOCK_BYTES
        before += int(offsets[-1])
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if high > low:
                yield base + int(block[low]), batch.slice(low, high - low)


def _by_block(pairs: Iterator[tuple]) -> Iterator[tuple]:
    block, rows = None, []
    for new, batch in pairs:
        if new != block and rows:
            yield block, rows
            rows = []
        block = new
        rows.append(batch)
    if rows:
        yield block, rows


def _block_grams(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for block, rows in _by_block(_blocks(batches, 0)):
        found = np.zeros(0, np.int64)
        for batch in rows:
            for _, data, offsets in chunks(batch, 0):
                found = np.union1d(found, _grams(data, offsets, order)[0])
        for low in range(0, len(found), 1 << 16):
            own = found[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), block)), pa.array(own)], names=["block", "gram"]
            )
    give_back()


def _block_texts(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Each block's rows as one compressed Arrow stream."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    for block, rows in _by_block(_blocks(batches, text)):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows[0].schema, options=options) as writer:
            for batch in rows:
                writer.write_batch(batch)
        columns = [pa.array([block]), pa.array([out.getvalue().to_pybytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "rows"])


def _score(
    texts: pa.Table, grams: pa.Table, order: int, text: int, columns: Sequence[str]
) -> pa.Table:
    found = pa.concat_tables(_scored(texts, grams, order, text, columns))
    # Copied, as slices keep the whole batch they are of; what it took goes back.
    found = found.take(pa.array(np.arange(len(found))))
    give_back()
    return found


def _scored(
    texts: pa.Table, grams: pa.Table, order: int, text: int, columns: Sequence[str]
) -> list[pa.Table]:
    gram = grams.column("gram").to_numpy()
    by = np.argsort(gram)
    gram, logp = gram[by], grams.column("logp").to_numpy()[by].astype(np.float64)
    out = []
    for stream in texts.column("rows"):
        for batch in pa.ipc.open_stream(stream.as_buffer()):
            for rows, data, offsets in chunks(batch, text):
                own, ends = _grams(data, offsets, order)
                at = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
                if not np.array_equal(gram[at], own):
                    raise RuntimeError("the documents were dealt to other tasks on a second read")
                total = np.add.reduceat(logp[at], ends[:-1])
                size = np.diff(ends)
                scored = pa.Table.from_batches([rows]).select(columns)
                scored = scored.append_column("kn_symbols", pa.array(size))
                out.append(scored.append_column("kn_log_perplexity", pa.array(-total / size)))
    return out


def score(
    docs: DataFrame,
    model: Model,
    keep: Sequence[str],
    text: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """``keep`` columns of every row, ``kn_symbols`` and ``kn_log_perplexity``.

    ``docs`` is a table as it is read from files: it is scanned twice, and dealt to
    tasks alike.  The log perplexity is per byte, the end of the text counted as one.
    """
    order = len(model.counts)
    docs = docs.withColumn(text, F.col(text).cast("string"))
    grams = docs.select(text).mapInArrow(
        partial(_block_grams, order=order), "block long, gram long"
    )
    wanted = stage(grams, "block-grams", folder)
    logp = log_probabilities(wanted.select("gram").distinct(), model)
    logp = stage(logp, "log-probabilities", folder)
    found = wanted.join(logp, "gram").select("block", "gram", "logp")
    columns = list(dict.fromkeys([*keep, text]))
    rows = docs.select(*columns)
    at = columns.index(text)
    texts = rows.mapInArrow(partial(_block_texts, text=at), "block long, rows binary")
    judge = partial(_score, order=order, text=at, columns=list(keep))

    def scored(texts: pa.Table, grams: pa.Table) -> pa.Table:
        return judge(texts, grams)

    schema = rows.select(*keep).schema.add("kn_symbols", "long").add("kn_log_perplexity", "double")
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(scored, schema)


def _judged(rows: DataFrame, held: DataFrame, pooled: float, folder: str | None) -> DataFrame:
    """The rows with ``excess`` and ``threshold``, by tables of languages that are joined."""
    by_lang = held.groupBy(F.col("lang").alias("language")).agg(
        F.count("*").alias("n"), F.median("v").alias("median")
    )
    # A null language is joined with none.
    own = by_lang.where(f"n >= {MIN_HELD_OUT} AND language IS NOT NULL").select("language", "median")
    own = stage(own, "medians", folder)

    def excess(df: DataFrame, value: str, center: Column) -> DataFrame:
        return df.withColumn("excess", (F.col(value) - center) * F.sqrt("kn_symbols"))

    def fence(df: DataFrame, *by: str) -> DataFrame:
        # On a grid, the exact quantiles' state is bounded.
        e = F.round("excess", 2)
        low, high = (F.percentile(e, x) for x in (0.25, 0.75))
        return df.groupBy(*by).agg((high + FENCE * (high - low)).alias("fence"))

    of_own = excess(held.join(own, F.col("lang") == F.col("language")), "v", F.col("median"))
    fences = fence(of_own, "language", "median")
    languages = stage(fences, "fences", folder)
    limit = F.lit(float(fence(excess(held, "v", F.lit(pooled))).first()["fence"]))
    joined = rows.join(languages, F.col("lang") == F.col("language"), "left")
    joined = excess(joined, "kn_log_perplexity", F.coalesce("median", F.lit(pooled)))
    return joined.withColumn("threshold", F.coalesce("fence", limit))


def classify(
    docs: DataFrame, trusted: DataFrame, keep: Sequence[str], folder: str | None = None
) -> DataFrame:
    """``keep`` columns of every row, ``perplexity``, ``excess``, ``threshold``, ``accepted``.

    Kept columns with one of those names are left out.

    ``docs`` needs (doc_id, text, lang); ``trusted`` names good texts by ``doc_id``.  The
    model counts all trusted texts but one in five, which are held out.  A row's excess
    is how far its log perplexity lies above the median of its language's held-out
    texts, times the root of its length, as short texts vary more.  The threshold is
    that language's upper quartile of excess and FENCE interquartile ranges.

    Languages with under MIN_HELD_OUT held-out texts, null among them, take all
    languages' quantiles.  Without any held-out text all rows are accepted.  Null and
    empty texts are judged like others, by their end alone.  Rows that share a
    ``doc_id`` are judged one by one.  An empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    trusted = stage(trusted.select("doc_id").where("doc_id IS NOT NULL").distinct(), "trusted", folder)
    some = F.broadcast(trusted) if trusted.count() <= MAX_BROADCAST else trusted
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    texts = docs.select("doc_id", "text").where(~held_out).join(some, "doc_id", "semi")
    model = train(texts.select("text"), folder)
    # The documents' columns go by number, so that none clashes with another here.
    names = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*keep, "doc_id", "lang", "text"]))}
    renamed = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in names.items()))
    columns = [name for c, name in names.items() if c != "text" or "text" in keep]
    rows = score(renamed, model, columns, names["text"], folder)
    rows = stage(rows, "scored", folder)
    rows = rows.withColumns({"doc_id": F.col(names["doc_id"]), "lang": F.col(names["lang"])})
    # On a grid, the exact quantiles' state is bounded.
    held = rows.where(held_out).join(some, "doc_id", "semi")
    held = held.select("lang", "kn_symbols", F.round("kn_log_perplexity", 4).alias("v"))
    pooled = held.agg(F.median("v")).first()[0]
    if pooled is None:
        judged = rows.withColumns({"excess": F.lit(0.0), "threshold": F.lit(0.0)})
    else:
        judged = _judged(rows, held, float(pooled), folder)
    verdict = {
        "perplexity": F.exp("kn_log_perplexity"),
        "excess": F.col("excess"),
        "threshold": F.col("threshold"),
        "accepted": F.col("excess") <= F.col("threshold"),
    }
    kept = [F.col(names[c]).alias(c) for c in keep if c not in verdict]
    return judged.select(*kept, *(v.alias(k) for k, v in verdict.items()))


def accepted(docs: DataFrame, trusted: DataFrame, folder: str | None = None) -> DataFrame:
    """The accepted rows, all columns, each judged by itself, whatever its id.

    Null and empty texts are judged by their end alone, and a null language or one with few
    held-out texts by all languages.  Only numbers of rows go through the judging; the
    rejected ones are then left out.
    """
    number = f"row_{uuid.uuid4().hex[:8]}"
    again = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if again.isEmpty():
        numbered = docs.withColumn(number, F.col("doc_id"))
    else:
        numbered = docs.withColumn(number, F.monotonically_increasing_id())
        numbered = stage(numbered, "numbered-rows", folder)
    judged = classify(numbered, trusted, [number], folder)
    gone = stage(judged.where("NOT accepted").select(number), "rejected", folder)
    return numbered.join(gone, number, "anti").select(*docs.columns)
