"""CSV records that run over lines, read by many tasks.

The text source cuts files at line breaks, wherever a split ends.  Whether a line break
ends a record depends on all quotes before it in its file: outside quoted fields their
number is even, as a quote inside a quoted field is doubled.  So

- each task joins the lines it scans, in their order, to chunks of a block, and counts their
  quotes as if the block began outside quotes, and the lines that end at an even and at an
  odd number,
- running sums over the blocks of a file, one row each, say how each block does begin,
- and with that every chunk is cut into records.

Records that lie in one chunk, most of them, stay where they are; the pieces of others, two
of a chunk at most, are put together by record.  No task reads a whole file, and no line is
sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmart.operators.row_ids import (
    BLOCK_BYTES,
    MAX_BROADCAST_BYTES,
    POSITION,
    with_file_position,
)
from reviewmart.scratch import stage
from reviewmart.shipping import ship_package

BLOCK = ("file_path", "block_start")
# A record of more bytes is taken for a quote that is never closed where it should be.
MAX_RECORD_BYTES = 256 << 20
# Lines of a chunk; a longer line is a chunk of its own.
CHUNK_BYTES = 1 << 20

_COUNTS = (
    "n",  # Lines.
    "odd",  # Quotes, modulo 2.
    # Before the chunk, if its block begins outside quotes: whether it begins inside, and
    # the lines of the block that end outside and inside.
    "opened",
    "closed_before",
    "open_before",
    # Its lines that end inside then.
    "n_open",
    # Bytes up to the end of the first and last line that end outside, and inside.
    "first_closed",
    "last_closed",
    "first_open",
    "last_open",
    "size",
)
_CHUNKS = ", ".join(
    [
        "file_path string, block_start long, scan_order long",
        *(f"{c} long" for c in _COUNTS),
        "returns boolean, text binary",
    ]
)


def _edges(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of lines with at most ``limit`` bytes, or of one line."""
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, stop
        at = stop


def _ends(ended: np.ndarray, ends: np.ndarray, how: int) -> tuple[int | None, int | None]:
    found = np.flatnonzero(ended == how)
    return (int(ends[found[0]]), int(ends[found[-1]])) if len(found) else (None, None)


def _join_lines(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Chunks of consecutive lines; a task scans its blocks one after the other."""
    schema = pa.schema(
        [("file_path", pa.string()), ("block_start", pa.int64()), ("scan_order", pa.int64())]
        + [(c, pa.int64()) for c in _COUNTS]
        + [("returns", pa.bool_()), ("text", pa.binary())]
    )
    block, opened, closed_before, open_before = None, 0, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        value, path = batch.column("value"), batch.column("file_path")
        start, scan = (batch.column(c).to_numpy() for c in ("block_start", "scan_order"))
        odd = pc.count_substring(value, '"').to_numpy().astype(np.int64) & 1
        size = pc.binary_length(value).to_numpy().astype(np.int64) + 1
        file = path.dictionary_encode().indices.to_numpy()
        turn = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        rows = []
        for a, b in zip([0, *turn], [*turn, len(start)], strict=True):
            name = path[int(a)].as_py()
            if block != (name, start[a]):
                block, opened, closed_before, open_before = (name, start[a]), 0, 0, 0
            for i, j in _edges(np.cumsum(size[a:b]), limit):
                i, j = int(a) + i, int(a) + j
                ended = (opened + np.cumsum(odd[i:j])) & 1
                ends = np.cumsum(size[i:j])
                n_open = int(ended.sum())
                lines = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), value.slice(i, j - i))
                rows.append(
                    (name, start[a], scan[i], j - i, int(odd[i:j].sum()) & 1)
                    + (opened, closed_before, open_before, n_open)
                    + (*_ends(ended, ends, 0), *_ends(ended, ends, 1), int(ends[-1]))
                    + (value[i].as_py().endswith(b"\r"), pc.binary_join(lines, b"\n")[0])
                )
                opened = int(ended[-1])
                closed_before, open_before = closed_before + j - i - n_open, open_before + n_open
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines in chunks, with their place in the block and the counts above."""
    ship_package(spark)
    scan = spark.read.option("lineSep", "\n").text(paths).select("value", "_metadata")
    lines = with_file_position(scan.withColumn("value", F.col("value").cast("binary")))
    join = partial(_join_lines, limit=min(CHUNK_BYTES, MAX_RECORD_BYTES))
    chunks = lines.select(*POSITION, "value").mapInArrow(join, _CHUNKS)
    return chunks.withColumn("text", F.col("text").cast("string"))


def _blocks(chunks: DataFrame) -> DataFrame:
    """File blocks: whether each begins inside quotes, and the records ended before it."""
    counted = chunks.groupBy(*BLOCK).agg(
        F.sum("n").alias("n"),
        (F.max(F.col("scan_order") + F.col("n")) - F.min("scan_order")).alias("numbers"),
        (F.sum("odd") % 2).alias("turns"),
        F.sum("n_open").alias("n_open"),
        F.min_by("returns", "scan_order").alias("returns"),
    )
    order = Window.partitionBy("file_path").orderBy("block_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def running(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    placed = counted.withColumn("begins", running("turns") % 2)
    ended = F.when(F.col("begins") == 0, F.col("n") - F.col("n_open")).otherwise(F.col("n_open"))
    # The first line says how those of its file end.
    placed = placed.withColumn("returns", F.first("returns").over(order))
    return placed.withColumn("ended", ended).withColumn("ended_before", running("ended"))


def _checked(blocks: DataFrame) -> int:
    """Bytes the blocks take; an error if a file is torn or ends inside quotes."""
    torn = F.count_if(F.col("n") != F.col("numbers"))
    size = F.sum(F.octet_length("file_path") + BLOCK_BYTES)
    found = blocks.agg(torn.alias("torn"), size.alias("size")).first()
    if found["torn"]:
        raise ValueError("lines of a file block are not consecutive; is a file read twice?")
    files = blocks.groupBy("file_path").agg((F.sum("turns") % 2).alias("open"))
    open_ = files.where("open = 1").agg(F.count("*").alias("n"), F.min("file_path").alias("one")).first()
    if open_["n"]:
        raise ValueError(f"{open_['n']} CSV files end inside a quoted field, one is {open_['one']}")
    return found["size"] or 0


def _well_quoted(text: Column) -> Column:
    """True, or an error where a quote stands inside a field that does not begin with one."""
    # Every stretch between two quotes becomes one quote; a doubled quote ends one and
    # begins the next.
    runs = F.regexp_replace(text, '"[^"]*+"', '"')
    message = F.concat(
        F.lit("a CSV record over several lines has a quote inside a field without quotes: "),
        F.substring(text, 1, 200),
    )
    return F.when(~runs.rlike('[^,"]"|"[^,"]'), True).otherwise(
        F.raise_error(message).cast("boolean")
    )


def _largest(placed: DataFrame) -> int:
    """Bytes of the largest record that lies in several chunks; no text is read."""
    inside, stays = F.col("inside") == 1, F.col("stays") == 1
    # Of a chunk without a record's end all belongs to the record it begins in.
    tail = F.col("size") - F.coalesce("last_end", F.lit(0))
    last = F.col("first_record") + F.col("ended")
    pieces = F.array(
        F.struct(
            F.col("first_record").alias("record"),
            F.when(inside, F.coalesce("first_end", "size")).alias("size"),
        ),
        F.struct(
            last.alias("record"),
            F.when(stays & (~inside | F.col("last_end").isNotNull()), tail).alias("size"),
        ),
    )
    parts = placed.select("file_path", F.inline(pieces)).where("size IS NOT NULL")
    sizes = parts.groupBy("file_path", "record").agg(F.sum("size").alias("size"))
    return sizes.agg(F.max("size")).first()[0] or 0


# Text up to a line feed outside quotes.
_RECORD = r'((?:[^"\n]++|"[^"]*+")*+)\n'


def csv_records(
    spark: SparkSession,
    paths: list[str],
    folder: str | None = None,
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``file_path, record, text``: all records, numbered from 0 in their file.

    Lines end with a line feed.  In a file whose first line has a carriage return before it,
    so may the others, and the two are read as a line feed, inside quotes too; elsewhere a
    carriage return is a character like others.  Blank lines outside quotes are no records, but are counted; a mark at the
    beginning of a file is left out.  A file that ends inside quotes is an error, as is a
    record over several lines with a quote inside a field that does not begin with one.

    Chunks of lines are written, as another scan might be split differently.  A record
    comes with its chunk's ``first_record``, by which chunks are left out unread.
    """
    chunks = stage(_chunks(spark, paths), "csv-chunks", folder, compression="zstd")
    blocks = stage(_blocks(chunks), "csv-blocks", folder)
    if _checked(blocks) <= max_broadcast:
        blocks = F.broadcast(blocks)
    known = blocks.select(*BLOCK, "begins", "ended_before", F.col("returns").alias("in_file"))

    def either(closed: Column | str, open_: Column | str) -> Column:
        """Of a block that begins outside quotes, and of one that begins inside."""
        closed, open_ = (F.col(c) if isinstance(c, str) else c for c in (closed, open_))
        return F.when(F.col("begins") == 0, closed).otherwise(open_)

    placed = chunks.join(known, list(BLOCK)).select(
        *POSITION,
        (F.col("ended_before") + either("closed_before", "open_before")).alias("first_record"),
        # Whether the chunk begins and ends inside quotes.
        ((F.col("begins") + F.col("opened")) % 2).alias("inside"),
        ((F.col("begins") + F.col("opened") + F.col("odd")) % 2).alias("stays"),
        either(F.col("n") - F.col("n_open"), "n_open").alias("ended"),
        either("first_closed", "first_open").alias("first_end"),
        either("last_closed", "last_open").alias("last_end"),
        "size",
        "in_file",
        "text",
    )
    largest = _largest(placed)
    if largest > MAX_RECORD_BYTES:
        raise ValueError(f"a CSV record takes {largest} bytes; a quote seems not to be closed")
    inside, stays = F.col("inside") == 1, F.col("stays") == 1
    quote = F.lit('"')
    text = F.when(F.col("in_file"), F.regexp_replace("text", r"\r(?=\n|\z)", ""))
    text = text.otherwise(F.col("text"))
    # Quotes around what another chunk begins or ends, taken off again below.
    text = F.concat(
        F.when(inside, quote).otherwise(""), text, F.when(stays, quote).otherwise(""), F.lit("\n")
    )
    cut = F.posexplode(F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1)))
    pieces = placed.select(*POSITION, "first_record", "inside", "stays", "ended", cut.alias("at", "piece"))
    begun, broken = inside & (F.col("at") == 0), stays & (F.col("at") == F.col("ended"))
    pieces = pieces.select(
        *POSITION,
        "first_record",
        (F.col("first_record") + F.col("at")).alias("record"),
        begun.cast("int").alias("begun"),
        broken.cast("int").alias("broken"),
        "piece",
    )
    whole = pieces.where("begun + broken = 0")
    parts = pieces.where("begun + broken > 0").withColumn(
        "piece", F.expr("substring(piece, 1 + begun, length(piece) - begun - broken)")
    )
    key = ["file_path", "record"]
    ordered = F.sort_array(F.collect_list(F.struct("block_start", "scan_order", "piece")))
    joined = parts.groupBy(*key).agg(ordered.alias("pieces")).select(
        *key, F.col("record").alias("first_record"), F.array_join("pieces.piece", "\n").alias("text")
    )
    records = whole.select(*key, "first_record", F.col("piece").alias("text")).union(joined)
    lines = ~F.contains("text", F.lit("\n"))
    text = F.regexp_replace("text", "\\A\ufeff", "")
    records = records.where(lines | _well_quoted(F.col("text")))
    return records.select(*key, "first_record", text.alias("text")).where("record = 0 OR text <> ''")
