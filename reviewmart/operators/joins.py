"""A left join that spreads hot keys over many tasks.

A key whose rows are more than a task should hold would otherwise land in one.  Hot
keys are found with a mergeable frequent-items sketch in one pass over the key columns;
what a task should hold is bytes, and the sketch grows with the table.  Without any, the join is a plain one.  Otherwise the rows of a hot
key are dealt out to a grid of cells: left rows pick a grid row and are copied
to its cells, right rows pick a grid column and are copied to its cells, so
every pair meets exactly once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmart.session import planned_bytes

# What a task should hold of one key.  It can sort and spill that much.
PART_BYTES = 256 << 20
# Rows are some three times larger in a shuffle than stored.
SHUFFLED = 3
# Below this many rows one task copes with a key, however wide they are.
MIN_HOT_ROWS = 10_000
# A table of more parts than that gets larger ones: as many keys can be hot at most, and a
# sketch must track more of them than are.
SHARES = 20_000
# Items a sketch tracks for each share; estimates are off by 0.35 shares at most.
TRACKED, LEAST_TRACKED = 10, 4_000
# Each task makes one sketch; this many tasks merge them before the last one does.
MERGERS = 128

Parts = Mapping[object, int]


def hot_rows(rows: int, stored: int) -> int:
    """Rows of one key that a task should hold, for a table of so many rows and bytes."""
    fitting = PART_BYTES * rows // max(stored * SHUFFLED, 1)
    return max(fitting, MIN_HOT_ROWS, rows // SHARES)


def hot_key_parts(
    df: DataFrame, *keys: str, min_rows: int | None = None
) -> dict[str, dict[object, int]]:
    """For each key column, its hot values and into how many parts to cut each.

    A key is hot if its rows take more than PART_BYTES, by the table's mean row, or with
    ``min_rows`` if it has more rows.  One pass, after a count; one result row, with at
    most SHARES values for a column.  Pass a written table: then the count reads no rows,
    and the size is known.  A wrong estimate changes how work is spread, never the result
    of the join.
    """
    rows = df.count()
    target = hot_rows(rows, planned_bytes(df)) if min_rows is None else max(min_rows, rows // SHARES)
    shares = rows // target
    if not shares:
        return {k: {} for k in keys}
    tracked = max(TRACKED * shares, LEAST_TRACKED)
    made = [F.expr(f"approx_top_k_accumulate(`{k}`, {tracked})").alias(k) for k in keys]
    top = [
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(`{k}`), {shares})").alias(k)
        for k in keys
    ]
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS))
    sketches = df.groupBy(merger).agg(*made)
    # Grouped, so that no rows give no row: sketches cannot be combined from none.
    row = sketches.groupBy(F.lit("all")).agg(*top).first()
    if row is None:
        return {k: {} for k in keys}
    return {
        k: {t["item"]: -(-t["count"] // target) for t in row[k] if t["count"] > target}
        for k in keys
    }


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    left_parts: Parts | None = None,
    right_parts: Parts | None = None,
) -> DataFrame:
    """``left`` LEFT JOIN ``right``, hot keys cut as the parts say.

    ``right_parts`` may only name values that do occur in ``right``.
    """
    left_parts = dict(left_parts or {})
    right_parts = dict(right_parts or {})
    null_parts = left_parts.pop(None, 1)
    right_parts.pop(None, None)
    if not left_parts and not right_parts and null_parts == 1:
        return left.join(right, F.col(left_on) == F.col(right_on), "left")

    grid = _grid(left, left_on, left_parts, right_parts)
    out = [*left.columns, *right.columns]

    own_row = F.when(F.col(left_on).isNull(), F.lit(null_parts)).otherwise(_parts("l"))
    cells_l = _with_grid(left, left_on, grid).select(
        *left.columns,
        _pick(left.columns, own_row).alias("_row"),
        _parts("r").alias("_copies"),
    )
    cells_l = _copy(cells_l, "_copies", "_col", bool(right_parts))

    right = right.where(F.col(right_on).isNotNull())
    cells_r = _with_grid(right, right_on, grid).select(
        *right.columns,
        _pick(right.columns, _parts("r")).alias("_col_r"),
        _parts("l").alias("_copies_r"),
        F.lit(True).alias("_hit"),
    )
    cells_r = _copy(cells_r, "_copies_r", "_row_r", bool(left_parts))

    joined = cells_l.join(
        cells_r,
        (F.col(left_on) == F.col(right_on))
        & (F.col("_row") == F.col("_row_r"))
        & (F.col("_col") == F.col("_col_r")),
        "left",
    )
    if right_parts:
        # A value cut on the right has partners, so its unmatched copies only
        # met an empty cell.
        joined = joined.where(F.col("_hit") | (F.col("_copies") == 1))
    return joined.select(*out)


def _grid(left: DataFrame, key: str, left_parts: Parts, right_parts: Parts) -> DataFrame:
    """Hot values with their grid size: fewer than 2 * SHARES rows."""
    schema = T.StructType(
        [
            T.StructField("_hot", left.schema[key].dataType),
            T.StructField("_l", T.LongType()),
            T.StructField("_r", T.LongType()),
        ]
    )
    values = [*left_parts, *(v for v in right_parts if v not in left_parts)]
    rows = [(v, left_parts.get(v, 1), right_parts.get(v, 1)) for v in values]
    return left.sparkSession.createDataFrame(rows, schema).coalesce(1)


def _with_grid(df: DataFrame, key: str, grid: DataFrame) -> DataFrame:
    return df.join(F.broadcast(grid), F.col(key) == F.col("_hot"), "left")


def _parts(side: str) -> Column:
    return F.coalesce(F.col(f"_{side}"), F.lit(1))


def _pick(columns: list[str], parts: Column) -> Column:
    """A part number that stays the same when a task is run again.

    The partition id spreads rows that are copies of each other.
    """
    spread = F.pmod(F.xxhash64(*columns, F.spark_partition_id()), parts)
    return F.when(parts > 1, spread).otherwise(F.lit(0).cast("bigint"))


def _copy(df: DataFrame, copies: str, cell: str, needed: bool) -> DataFrame:
    if not needed:
        return df.withColumn(cell, F.lit(0).cast("bigint"))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1)
    return df.withColumn(cell, F.explode(numbers))
