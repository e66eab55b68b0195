"""Numbering rows 1..n in file order without sorting or moving them.

A scan hands each task whole file blocks.  Within a block the rows have
consecutive scan numbers, so a row's id is

    rows in earlier files + rows in earlier blocks of its file
    + its place within the block.

Only the first two need other rows, and they need one count per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewmart.scratch import stage

POSITION = ("file_path", "block_start", "scan_order")

# File blocks whose offsets take at most so many bytes are broadcast; beyond it both
# sides are shuffled by block.
MAX_BROADCAST_BYTES = 32 << 20
# Numbers and overhead of one block, besides its path.
BLOCK_BYTES = 64


def with_file_position(scan: DataFrame) -> DataFrame:
    """Add the position columns to rows that come straight from a file scan.

    ``scan`` holds the ``_metadata`` column of the scan; no shuffle may lie
    between the two.
    """
    return scan.select(
        *[c for c in scan.columns if c != "_metadata"],
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("scan_order"),
    )


def file_blocks(positioned: DataFrame) -> DataFrame:
    """One row per file block: its row count, first and last scan number."""
    return positioned.groupBy("file_path", "block_start").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("scan_order").alias("first_scan"),
        F.max("scan_order").alias("last_scan"),
    )


def with_offsets(blocks: DataFrame, folder: str | None = None) -> DataFrame:
    """File blocks with the number of rows before each.

    Files are dealt out in ranges of their paths, so the running sum across them is
    one per range.  Only the ranges' totals, no more than the shuffle has partitions,
    are summed on the driver.
    """
    before = (Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(*before)
    in_range = Window.partitionBy("range").orderBy("file_path").rowsBetween(*before)

    def running(window):
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    files = blocks.groupBy("file_path").agg(F.sum("n").alias("n"))
    ranged = files.repartitionByRange("file_path").withColumn("range", F.spark_partition_id())
    # Written, as a range's number must stay what it was.
    ranged = stage(ranged, "files", folder)
    totals = ranged.groupBy("range").agg(F.sum("n").alias("n")).collect()
    starts, total = [], 0
    for r in sorted(totals):
        starts.append((r["range"], total))
        total += r["n"]
    ranges = blocks.sparkSession.createDataFrame(starts, "range int, range_offset bigint")
    files = ranged.withColumn("in_range", running(in_range)).join(F.broadcast(ranges), "range")
    files = files.select(
        "file_path", (F.col("range_offset") + F.col("in_range")).alias("file_offset")
    )
    rows_before = F.col("file_offset") + F.col("in_file")
    return (
        blocks.withColumn("in_file", running(in_file))
        .join(files, "file_path")
        .select("file_path", "block_start", "first_scan", rows_before.alias("rows_before"))
    )


def number_rows(
    positioned: DataFrame,
    id_column: str,
    max_broadcast: int = MAX_BROADCAST_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """Replace the position columns of a *written* table by an id 1..n.

    The table must be written because a second scan of the raw files may be
    split differently, for instance after executors were lost or added.  The
    blocks are written, to ``folder`` if given, and measured: when they take few
    bytes, no row moves.
    """
    blocks = stage(file_blocks(positioned), "blocks", folder)
    torn = F.col("last_scan") - F.col("first_scan") + 1 != F.col("n")
    size = F.sum(F.octet_length("file_path") + BLOCK_BYTES)
    found = blocks.agg(size.alias("size"), F.count_if(torn).alias("torn"))
    found = found.first()
    if found["torn"]:
        raise ValueError("rows of a file block are not consecutive; is a file read twice?")
    offsets = with_offsets(blocks, folder)
    if (found["size"] or 0) <= max_broadcast:
        offsets = F.broadcast(offsets)
    row_id = F.col("rows_before") + F.col("scan_order") - F.col("first_scan") + 1
    payload = [c for c in positioned.columns if c not in POSITION]
    return positioned.join(offsets, ["file_path", "block_start"]).select(
        *payload, row_id.cast("bigint").alias(id_column)
    )
