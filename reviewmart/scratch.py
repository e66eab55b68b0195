"""Where intermediate tables go.

Intermediate tables are written to the shared folder the cluster names in
``spark.checkpoint.dir``, so they outlive a lost executor.  Only a local
session without that setting gets a folder of its own.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        # In local-cluster mode executors are processes of their own.
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="reviewmart-"))
    return context.getCheckpointDir().rstrip("/")


# Applications' folders that go when the driver's program ends.
_passing: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path; nothing else writes there.  It lasts as long as the program."""
    home = f"{scratch_root(spark)}/reviewmart/{spark.sparkContext.applicationId}"
    if home not in _passing:
        _passing.add(home)
        atexit.register(_sweep, spark.sparkContext._jvm, home)
    return f"{home}/{label}-{uuid.uuid4().hex}"


def _sweep(jvm, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM may have gone before
        pass


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh folder that is gone when the block ends."""
    folder = scratch_path(spark, label)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path, True)


def stage(
    df: DataFrame, label: str, folder: str | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``df`` once as Parquet and return the written table.

    Later readers share one computation, get real size statistics for join
    planning, and prune columns.  Without a ``folder`` the table stays, as a
    checkpoint would.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}" if folder else scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
