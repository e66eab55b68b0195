"""Dimension tables.

Each has one row per log record, keyed by the record's id, and takes enriched
logs.  All are narrow projections: no shuffle, and each reads only the columns
it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.logs import log_date, season_of


def dim_date(logs: DataFrame) -> DataFrame:
    dated = logs.select("id_review", log_date(F.col("logDate")).alias("log_date"))
    day = F.col("log_date")
    return dated.select(
        F.col("id_review").cast("bigint").alias("id_dim_date"),
        day,
        F.dayofmonth(day).cast("string").alias("day"),
        F.month(day).cast("string").alias("month"),
        F.year(day).cast("string").alias("year"),
        season_of(day).alias("season"),
    )


def _attribute(logs: DataFrame, name: str, key: str) -> DataFrame:
    return logs.select(
        F.col("id_review").cast("bigint").alias(key),
        F.col(name).cast("string").alias(name),
    )


def dim_devices(logs: DataFrame) -> DataFrame:
    return _attribute(logs, "device", "id_dim_devices")


def dim_location(logs: DataFrame) -> DataFrame:
    return _attribute(logs, "location", "id_dim_location")


def dim_os(logs: DataFrame) -> DataFrame:
    return _attribute(logs, "os", "id_dim_os")


def dim_browser(logs: DataFrame) -> DataFrame:
    """Keeps the rows without a browser."""
    return _attribute(logs, "browser", "id_dim_browser")


DIMENSIONS = {
    "dim_date": dim_date,
    "dim_devices": dim_devices,
    "dim_location": dim_location,
    "dim_os": dim_os,
    "dim_browser": dim_browser,
}
