"""Every write replaces its target, except ``create_table``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmart.schemas import ddl
from reviewmart.scratch import delete_folder
from reviewmart.sinks.versions import KEEP_HOURS, current_path, place_of, write_version
from reviewmart.sources.csv import DIALECT

# Formats the catalog stores itself; any other name is a connector.
CATALOG_FORMATS = frozenset({"parquet", "orc", "csv", "json"})

# Spark would trim fields and cut timestamps to milliseconds.
EXACT = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
}


def write_parquet(df: DataFrame, path: str, merge: bool = False) -> None:
    """``merge`` shuffles the rows into few files of the advisory size.

    For rows much smaller than the input they come from, where one file per
    task would be tiny.
    """
    if merge:
        df = df.hint("rebalance")
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Uncompressed, with a header line in every file.

    Reading back gives the same rows, but for empty strings: they become NULL.
    """
    writer = df.write.mode("overwrite").options(**DIALECT, **EXACT)
    writer.csv(path, compression="none")


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    keep_hours: float = KEEP_HOURS,
) -> None:
    """Replace a table, making its database if it is missing.

    Catalog formats take ``path`` in ``options`` for a table outside the warehouse folder.
    The rows are in a version folder below it, see :mod:`reviewmart.sinks.versions`;
    whoever reads by path asks ``tables.read_current``.  It does not matter whether the
    session's catalog knows the table.  A replaced version is kept for ``keep_hours``.
    A connector takes whatever it needs in ``options``, for instance the bucket it stages
    files in.
    """
    options = dict(options or {})
    if fmt in CATALOG_FORMATS:
        _create_database(df.sparkSession, name)
        _replace(df, name, fmt, options, keep_hours)
        return
    writer = df.write.format(fmt).mode("overwrite").options(**options)
    writer.option("dbtable" if fmt == "jdbc" else "table", name).save()


def _replace(
    df: DataFrame, name: str, fmt: str, options: dict[str, str], keep_hours: float = KEEP_HOURS
) -> None:
    """Write the rows to a fresh version folder, then point the table there.

    Until all rows are written, and if that fails, the table is as it was.  ``df`` may
    read the table.
    """
    spark = df.sparkSession
    known = spark.catalog.tableExists(name)
    details = _details(spark, name) if known else {}
    given = options.pop("path", None)
    place = given or (place_of(details["Location"]) if known else _default_place(spark, name))
    writer = df.write.format(fmt).options(**options)
    fresh = write_version(spark, place, lambda path: writer.save(path), keep_hours)
    kinds = [(f.name, f.dataType) for f in df.schema.fields]
    if known and details["Provider"] == fmt and kinds == [
        (f.name, f.dataType) for f in spark.table(name).schema.fields
    ]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(fresh)}")
    else:
        # Other columns: the catalog has no way to change them in one step.  Should the
        # program end between the two, the rows are there and the next write makes the table.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({ddl(df.schema)}) USING {fmt} LOCATION {_literal(fresh)}")
    spark.catalog.refreshTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table of the catalog with all its versions."""
    place = place_of(_details(spark, name)["Location"])
    spark.sql(f"DROP TABLE {name}")
    delete_folder(spark, place)


def _literal(text: str) -> str:
    """As an SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _default_place(spark: SparkSession, name: str) -> str:
    """Where the catalog would put a table's rows."""
    database, _, table = name.rpartition(".")
    rows = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").collect()
    location = next(r["info_value"] for r in rows if r["info_name"] == "Location")
    return f"{location.rstrip('/')}/{table.lower()}"


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _create_database(spark: SparkSession, table: str) -> None:
    database = table.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> None:
    """Create the table, and its database, unless they exist.

    Rows that another session has written to its folder are the table's.
    """
    _create_database(spark, name)
    if spark.catalog.tableExists(name):
        return
    place = location or _default_place(spark, name)
    path = current_path(spark, place) or place
    columns = f"{name} ({ddl(schema)}) USING parquet"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {columns} LOCATION {_literal(path)}")


def full_refresh(df: DataFrame, name: str) -> None:
    """Leave exactly the rows of ``df`` in an existing table.

    Columns go by name.  All rows are written elsewhere first, once: if that fails
    the table stays as it was, and ``df`` may read the table itself.
    """
    table = df.sparkSession.table(name).schema
    _replace(df.select(*(F.col(f.name).cast(f.dataType) for f in table)), name, "parquet", {})


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Name DataFrames for SQL users of the session."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
