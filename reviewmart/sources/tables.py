"""Staged Parquet folders and catalog or connector tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reviewmart.schemas import STAGED_LOGS, STAGED_REVIEWS
from reviewmart.sinks.versions import current_path


def read_staged(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> DataFrame:
    """Whole Parquet folders, never single part files.

    A column that no file has is an error: under the declared schema alone it would be
    NULL in every row.  Spark reads the footers for this, in many tasks.
    """
    paths = [path] if isinstance(path, str) else path
    found = spark.read.option("mergeSchema", "true").parquet(*paths).columns
    missing = {f.lower() for f in schema.names} - {c.lower() for c in found}
    if missing:
        raise ValueError(f"no column {sorted(missing)} in {found} of {paths}")
    return spark.read.schema(schema).parquet(*paths)


def read_staged_reviews(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_staged(spark, path, STAGED_REVIEWS)


def read_staged_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_staged(spark, path, STAGED_LOGS)


def read_table(
    spark: SparkSession,
    name: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All rows of a table.

    Without ``fmt`` the name is looked up in the catalog.  With it, the named
    connector reads the table: ``jdbc`` takes it as ``dbtable`` (give
    ``partitionColumn``, bounds and ``numPartitions`` to read in parallel),
    others as ``table``.
    """
    if fmt is None:
        return spark.table(name)
    key = "dbtable" if fmt == "jdbc" else "table"
    return spark.read.format(fmt).options(**(options or {})).option(key, name).load()


def read_current(spark: SparkSession, place: str, fmt: str = "parquet") -> DataFrame:
    """The rows of a written table by its folder, without a catalog.

    What is read is the version that counts now; it stays readable while newer ones are
    written, until it is purged.
    """
    path = current_path(spark, place)
    if path is None:
        raise ValueError(f"no table was written to {place}")
    return spark.read.format(fmt).load(path)
