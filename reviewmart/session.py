"""Session settings the plans were written for."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution merges small shuffle partitions to the advisory size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above, where neither cluster nor caller differ.

    On a cluster pass ``spark.checkpoint.dir`` as a folder all executors share.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not given.contains(key) and key not in settings:
            spark.conf.set(key, value)
    return spark


# One shuffle partition for this much stored input; AQE merges those that turn
# out small.  Rows are some three times larger in a shuffle than in Parquet.
INPUT_PER_PARTITION = 48 << 20
# Scan tasks times shuffle partitions is the number of blocks a shuffle moves, so
# beyond these numbers the pieces get larger first.  A shuffle partition has its
# limit, which a task can still sort; from there on their number grows again.
MANY_PARTITIONS = 32_768
MOST_PER_PARTITION = 512 << 20
MAX_SCAN_TASKS = 32_768
MAX_SPLIT = 1 << 30

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT = "spark.sql.files.maxPartitionBytes"


def stored_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Size of all files under ``paths``; no file is opened."""
    if not paths:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    total = files.load(list(paths)).agg(F.sum("length")).first()[0]
    return total or 0


def planned_bytes(df: DataFrame) -> int:
    """What the optimizer takes the rows' size to be; for a table its stored size.

    Nothing is read, and no file name reaches the program.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _bytes(size: str) -> int:
    """A size setting such as ``134217728b`` or ``128m`` in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shuffle_partitions(moved: int) -> int:
    """For so many stored bytes that are shuffled."""
    each = min(max(INPUT_PER_PARTITION, -(-moved // MANY_PARTITIONS)), MOST_PER_PARTITION)
    return -(-moved // each)


@contextmanager
def sized_for(
    spark: SparkSession,
    shuffled: Sequence[str] = (),
    scanned: Sequence[str] = (),
    moved: int = 0,
) -> Iterator[None]:
    """Size shuffles and scans for inputs, inside the block.

    Rows of the ``shuffled`` inputs are shuffled, if only after an aggregation that
    may not shrink them, as are ``moved`` bytes of inputs without a path; the ``scanned`` ones
    are not.  Partitions and splits are never fewer or smaller than the session asks for.
    """
    moved += stored_bytes(spark, shuffled)
    read = moved + stored_bytes(spark, scanned)
    split = min(-(-read // MAX_SCAN_TASKS), MAX_SPLIT)
    settings = {
        INITIAL: max(shuffle_partitions(moved), int(spark.conf.get("spark.sql.shuffle.partitions"))),
        SPLIT: max(split, _bytes(spark.conf.get(SPLIT))),
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
