"""Checks on a loaded table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``total_rows``."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))
