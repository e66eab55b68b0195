"""The batch jobs: paths and table names in, written tables out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from reviewmart.operators.row_ids import number_rows
from reviewmart.plans.dims import DIMENSIONS
from reviewmart.plans.facts import fct_movie_analytics, fct_users
from reviewmart.plans.staging import (
    DEFAULT_KEYWORD,
    reviews_union,
    split_os_browser,
    staged_reviews,
)
from reviewmart.schemas import PURCHASES, STAGED_LOGS
from reviewmart.scratch import scratch_folder, stage
from reviewmart.session import planned_bytes, sized_for
from reviewmart.sinks.writers import (
    create_table,
    full_refresh,
    write_csv,
    write_parquet,
    write_table,
)
from reviewmart.sources.csv import read_csv, read_purchases, read_reviews
from reviewmart.sources.review_logs import read_logs_csv, read_logs_text, read_logs_xml
from reviewmart.sources.tables import (
    read_staged,
    read_staged_logs,
    read_staged_reviews,
    read_table,
)


@dataclass(frozen=True)
class Warehouse:
    """Where dimension and fact tables go.

    ``database`` prefixes table names; ``location`` puts catalog tables under a
    folder of their own; ``options`` go to the connector as they are.
    """

    database: str | None = None
    fmt: str = "parquet"
    location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    def write(self, df: DataFrame, name: str) -> None:
        options = dict(self.options)
        if self.location:
            options["path"] = f"{self.location}/{name}"
        write_table(df, self.table(name), self.fmt, options)


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else path


def _sized_for_csv(spark: SparkSession, path: str | list[str], multi_line: bool):
    """Lines are shuffled only where records may run over several."""
    paths = _paths(path)
    return sized_for(spark, paths) if multi_line else sized_for(spark, scanned=paths)


def load_purchases(
    spark: SparkSession,
    csv_path: str | list[str],
    table: str,
    location: str | None = None,
    multi_line: bool = False,
    timestamp_format: str | None = None,
) -> None:
    """Land purchases: afterwards the table holds exactly the rows of the files.

    Columns go by position.  A value that does not parse fails the load, and the
    table stays as it was.
    """
    create_table(spark, table, PURCHASES, location)
    with (
        scratch_folder(spark, "load-purchases") as folder,
        _sized_for_csv(spark, csv_path, multi_line),
    ):
        rows = read_csv(
            spark,
            csv_path,
            PURCHASES,
            multi_line,
            by_name=False,
            strict=True,
            timestamp_format=timestamp_format,
            folder=folder,
        )
        full_refresh(rows, table)


def export_purchases(
    spark: SparkSession,
    table: str,
    csv_path: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """From the catalog, or with ``fmt`` from behind that connector."""
    write_csv(read_table(spark, table, fmt, options), csv_path)


def stage_reviews(
    spark: SparkSession,
    csv_path: str | list[str],
    out_path: str,
    keyword: str = DEFAULT_KEYWORD,
    multi_line: bool = False,
) -> dict[str, int]:
    """Flag reviews; only the narrow staged rows are shuffled, to merge files.

    Without ``multi_line`` a review with a line break is an error.  Returns what the
    writing pass has counted: ``rows``, ``odd_rows``, and the values that did not parse
    and are NULL, ``nulled_cid`` and ``nulled_id_review``.
    """
    counted = Observation("reviews")
    with (
        scratch_folder(spark, "stage-reviews") as folder,
        _sized_for_csv(spark, csv_path, multi_line),
    ):
        raw = read_reviews(spark, csv_path, multi_line, folder, counted)
        write_parquet(staged_reviews(raw, keyword), out_path, merge=True)
        return counted.get


def stage_logs(
    spark: SparkSession,
    path: str | list[str],
    out_path: str,
    layout: str = "csv",
    row_tag: str = "log",
    multi_line: bool = False,
) -> None:
    """Parse log records and give each an id.

    ``csv``: id and XML text in two columns, the record's own id is kept.
    ``text``: records in any arrangement, numbered in file order.
    ``xml``: the same by Spark's XML source, one task per file.
    ``xml-document``: the same for files that are whole documents.
    """
    readers = {
        "csv": read_logs_csv,
        "text": read_logs_text,
        "xml": read_logs_xml,
        "xml-document": partial(read_logs_xml, single_root=True),
    }
    if layout not in readers:
        raise ValueError(f"unknown log layout {layout!r}")
    with (
        scratch_folder(spark, "stage-logs") as folder,
        _sized_for_csv(spark, path, multi_line and layout == "csv"),
    ):
        options = {"multi_line": multi_line, "folder": folder} if layout == "csv" else {}
        logs = readers[layout](spark, path, row_tag, **options)
        if layout != "csv":
            parsed = stage(logs, "parsed", folder)
            logs = number_rows(parsed, "id_review", folder=folder)
        write_parquet(logs.select(*STAGED_LOGS.names), out_path)


def build_dims(spark: SparkSession, logs_path: str, warehouse: Warehouse) -> None:
    """Five tables; each write reads only its own columns of the staged logs."""
    logs = split_os_browser(read_staged_logs(spark, logs_path))
    for name, dim in DIMENSIONS.items():
        warehouse.write(dim(logs), name)


def _purchases(
    spark: SparkSession,
    source: str | list[str],
    fmt: str,
    multi_line: bool,
    folder: str,
) -> DataFrame:
    if fmt == "table":
        return read_table(spark, source)
    if fmt == "parquet":
        return read_staged(spark, source, PURCHASES)
    if fmt != "csv":
        raise ValueError(f"unknown format of purchases {fmt!r}")
    return read_purchases(spark, source, multi_line, folder)


def build_facts(
    spark: SparkSession,
    purchases: str | list[str],
    reviews_paths: list[str],
    logs_path: str,
    warehouse: Warehouse,
    load_ts: datetime | None = None,
    purchases_format: str = "csv",
    multi_line: bool = False,
) -> None:
    """Both fact tables.

    ``purchases`` are CSV files, Parquet folders, or the name of the landed table,
    as ``purchases_format`` says (``csv``, ``parquet``, ``table``).  CSV files whose
    fields hold line breaks need ``multi_line``; without it they are an error.

    The distinct reviews and the user totals are written once and read by all
    that follows, so nothing is computed twice and both facts carry the same
    totals.
    """
    given = [*reviews_paths, logs_path]
    if purchases_format == "table":
        landed = planned_bytes(read_table(spark, purchases))
    else:
        given, landed = [*given, *_paths(purchases)], 0
    with scratch_folder(spark, "build-facts") as folder, sized_for(spark, given, moved=landed):
        bought = _purchases(spark, purchases, purchases_format, multi_line, folder)
        parts = [read_staged_reviews(spark, p) for p in reviews_paths]
        reviews = stage(reviews_union(*parts), "reviews", folder)
        users = stage(fct_users(bought, reviews, load_ts), "users", folder)
        warehouse.write(users, "fct_users")

        logs = split_os_browser(read_staged_logs(spark, logs_path))
        fact = fct_movie_analytics(reviews, logs, users)
        warehouse.write(fact, "fct_movie_analytics")
