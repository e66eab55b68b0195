"""Every job as a query over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart import jobs
from reviewmart.checks import inputs
from reviewmart.plans import dims, facts, staging
from reviewmart.quality import row_count
from reviewmart.scratch import scratch_folder, scratch_path, stage
from reviewmart.session import sized_for
from reviewmart.sinks import writers
from reviewmart.sources import csv, tables

Query = Callable[[SparkSession, str], DataFrame]

LOAD_TS = datetime(2024, 1, 1, tzinfo=timezone.utc)
# Occurs in the given texts and in no stop word.
PLAIN_KEYWORD = "tion"
# Occurs in the given texts, is a stop word and part of others.
STOP_KEYWORD = "the"


def _table_name(label: str) -> str:
    return f"reviewmart_{label}_{uuid.uuid4().hex}"


def _write_purchases_csv(
    spark: SparkSession, sf_dir: str, path: str, detail: Column | None = None
) -> None:
    """The raw delivery; the join that makes it moves both its tables."""
    rows = inputs.purchases(spark, sf_dir)
    if detail is not None:
        rows = rows.withColumn("detail", detail)
    with sized_for(spark, [inputs.path(sf_dir, t) for t in ("lineitem", "orders")]):
        writers.write_csv(rows, path)


# Sources, landing, export


def load_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("purchases")
    with scratch_folder(spark, "purchases-csv") as path:
        _write_purchases_csv(spark, sf_dir, path)
        jobs.load_purchases(spark, path, name, scratch_path(spark, "purchases"))
    return tables.read_table(spark, name)


def purchases_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the landed table."""
    return row_count(load_purchases(spark, sf_dir))


def export_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("export")
    path = scratch_path(spark, "export-csv")
    with scratch_folder(spark, "purchases") as place:
        rows = inputs.purchases(spark, sf_dir)
        writers.write_table(rows, name, options={"path": place})
        jobs.export_purchases(spark, name, path)
        spark.sql(f"DROP TABLE {name}")
    return csv.read_purchases(spark, path)


def read_reviews_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "reviews-csv")  # The result reads it.
    writers.write_csv(inputs.reviews(spark, sf_dir), path)
    return csv.read_reviews(spark, path, multi_line=True)


def review_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What staging reviews has counted, where known ids do not parse."""
    unreadable = inputs.reviews(spark, sf_dir).selectExpr(
        "IF(id_review % 7 = 0, concat('no. ', cid), CAST(cid AS STRING)) AS cid",
        "review_str",
        "IF(id_review % 11 = 0, concat(id_review, '.5'), CAST(id_review AS STRING)) AS id_review",
    )
    with scratch_folder(spark, "reviews-csv") as path, scratch_folder(spark, "reviews") as out:
        writers.write_csv(unreadable, path)
        found = jobs.stage_reviews(spark, path, out, PLAIN_KEYWORD, multi_line=True)
    return spark.createDataFrame([found], ", ".join(f"{c} bigint" for c in found))


# Reviews


def review_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.review_tokens(inputs.reviews(spark, sf_dir)).select(
        "id_review",
        F.size("review_token").cast("bigint").alias("n_tokens"),
        F.size("review_token_sw").cast("bigint").alias("n_kept"),
    )


def stage_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged_reviews(inputs.reviews(spark, sf_dir), PLAIN_KEYWORD)


def stage_reviews_stopword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged_reviews(inputs.reviews(spark, sf_dir), STOP_KEYWORD)


def stage_reviews_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword that runs over two neighbouring tokens."""
    keyword = f"{PLAIN_KEYWORD},{STOP_KEYWORD}"
    return staging.staged_reviews(inputs.reviews(spark, sf_dir), keyword)


def reviews_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.preview(stage_reviews(spark, sf_dir), "review_id")


def reviews_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.reviews_union(
        staging.staged_reviews(inputs.reviews(spark, sf_dir), STOP_KEYWORD),
        staging.staged_reviews(inputs.more_reviews(spark, sf_dir), STOP_KEYWORD),
    )


def _written_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(reviews_union(spark, sf_dir), "reviews")


# Logs


def _staged_logs(spark: SparkSession, path: str, layout: str) -> DataFrame:
    out = scratch_path(spark, "staged-logs")
    jobs.stage_logs(spark, path, out, layout)
    return tables.read_staged_logs(spark, out)


def _write_log_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``id_review,<reviewlog><log>...</log></reviewlog>`` lines."""
    wrapped = F.concat(F.lit("<reviewlog>"), "log", F.lit("</reviewlog>"))
    lines = inputs.log_xml(inputs.logs(spark, sf_dir)).withColumn("log", wrapped)
    writers.write_csv(lines, path)


def stage_logs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch_folder(spark, "logs-csv") as path:
        _write_log_csv(spark, sf_dir, path)
        return _staged_logs(spark, path, "csv")


def _write_log_text(spark: SparkSession, sf_dir: str, path: str, pretty: bool) -> None:
    """Records without ids, in id order over all files."""
    ordered = inputs.logs(spark, sf_dir).orderBy("id_review")
    inputs.log_xml(ordered, pretty).select("log").write.text(path)


def stage_logs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per line, numbered in file order."""
    with scratch_folder(spark, "logs-text") as path:
        _write_log_text(spark, sf_dir, path, pretty=False)
        return _staged_logs(spark, path, "text")


def stage_logs_text_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records over several lines, cut at the closing tag, numbered in file order."""
    with scratch_folder(spark, "logs-text") as path:
        _write_log_text(spark, sf_dir, path, pretty=True)
        return _staged_logs(spark, path, "text")


def stage_logs_text_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments with tags in them, empty elements, several records without a line end."""
    odd = F.expr(
        "CASE id_review % 5 WHEN 0 THEN concat('<!-- no <log> -->', log)"
        " WHEN 1 THEN replace(log, '</log>', '</log >')"
        " WHEN 2 THEN concat(log, '<log/>', log) WHEN 3 THEN concat('<log />', log)"
        " ELSE replace(log, '<device>', '<!-- <os>no</os> <log> --><device>') END"
    )
    with scratch_folder(spark, "logs-text") as path:
        ordered = inputs.logs(spark, sf_dir).orderBy("id_review")
        inputs.log_xml(ordered).select(odd.alias("log")).write.text(path)
        return _staged_logs(spark, path, "text")


def stage_logs_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records over several lines by Spark's XML source, numbered in file order."""
    with scratch_folder(spark, "logs-xml") as path:
        _write_log_text(spark, sf_dir, path, pretty=True)
        return _staged_logs(spark, path, "xml")


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.split_os_browser(inputs.logs(spark, sf_dir))


def split_os_browser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.split_os_browser(inputs.logs(spark, sf_dir), contact=True)


# Dimensions


def _dim(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(_enriched(spark, sf_dir))


def dim_date_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to the warehouse and read back."""
    name = _table_name("dim_date")
    place = {"path": scratch_path(spark, "dim-date")}
    writers.write_table(dims.dim_date(_enriched(spark, sf_dir)), name, options=place)
    return tables.read_table(spark, name)


def season_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension used from SQL through a view."""
    view = _table_name("dim_date_view")
    writers.register_views({view: dims.dim_date(_enriched(spark, sf_dir))})
    return spark.sql(f"SELECT season, count(*) AS n_logs FROM {view} GROUP BY season")


# Facts


def spend_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.spend_per_customer(inputs.purchases(spark, sf_dir))


def score_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.score_per_user(reviews_union(spark, sf_dir))


def user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.user_behavior(
        inputs.purchases(spark, sf_dir), reviews_union(spark, sf_dir)
    )


def fct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = facts.fct_users(
        inputs.purchases(spark, sf_dir), reviews_union(spark, sf_dir), LOAD_TS
    )
    # As a zoneless UTC time, whatever the session's zone.
    local = F.col("insert_date").cast("timestamp_ntz")
    return users.withColumn("insert_date", F.convert_timezone(None, F.lit("UTC"), local))


def reviews_with_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.reviews_with_logs(
        _written_union(spark, sf_dir), _enriched(spark, sf_dir)
    )


def reviews_with_repeated_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many logs per id, ids of more than five logs or reviews cut as hot keys."""
    logs = inputs.logs(spark, sf_dir, row_id="o_custkey * 20")
    return facts.reviews_with_logs(
        _written_union(spark, sf_dir), staging.split_os_browser(logs), min_hot_rows=5
    )


def fct_movie_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = _written_union(spark, sf_dir)
    users = facts.user_behavior(inputs.purchases(spark, sf_dir), reviews)
    return facts.fct_movie_analytics(reviews, _enriched(spark, sf_dir), users)


def fct_movie_analytics_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with every reviewer of more than five reviews cut as a hot key."""
    reviews = _written_union(spark, sf_dir)
    users = facts.user_behavior(inputs.purchases(spark, sf_dir), reviews)
    logs = _enriched(spark, sf_dir)
    return facts.fct_movie_analytics(reviews, logs, users, min_hot_rows=5)


def mart_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs in a row: raw files in, written mart tables out."""
    place = scratch_path(spark, "mart")
    mart = jobs.Warehouse(_table_name("mart"), location=f"{place}/tables")
    spark.sql(f"CREATE DATABASE {mart.database} LOCATION '{place}/database'")
    with scratch_folder(spark, "mart-files") as root:
        raw, staged = f"{root}/raw", f"{root}/staged"
        _write_purchases_csv(spark, sf_dir, f"{raw}/purchases")
        writers.write_csv(inputs.reviews(spark, sf_dir), f"{raw}/reviews")
        writers.write_csv(inputs.more_reviews(spark, sf_dir), f"{raw}/more_reviews")
        _write_log_csv(spark, sf_dir, f"{raw}/logs")

        landed = _table_name("landed")
        jobs.load_purchases(spark, f"{raw}/purchases", landed, f"{root}/landed")
        jobs.export_purchases(spark, landed, f"{root}/export")
        spark.sql(f"DROP TABLE {landed}")
        parts = [f"{staged}/reviews", f"{staged}/more_reviews"]
        for part in parts:
            source = part.replace(staged, raw)
            jobs.stage_reviews(spark, source, part, STOP_KEYWORD, multi_line=True)
        logs = f"{staged}/logs"
        jobs.stage_logs(spark, f"{raw}/logs", logs, "csv")
        jobs.build_dims(spark, logs, mart)
        jobs.build_facts(spark, f"{root}/export", parts, logs, mart, LOAD_TS)
    return tables.read_table(spark, mart.table("fct_movie_analytics"))


def mart_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with line breaks in a field, landed, exported and read for the facts."""
    place = scratch_path(spark, "mart")
    mart = jobs.Warehouse(_table_name("mart"), location=f"{place}/tables")
    spark.sql(f"CREATE DATABASE {mart.database} LOCATION '{place}/database'")
    broken = F.expr("concat(detail, '\n', '\"', stock_code, '\r\n,')")
    with scratch_folder(spark, "mart-files") as root:
        _write_purchases_csv(spark, sf_dir, f"{root}/raw", broken)
        landed = _table_name("landed")
        jobs.load_purchases(spark, f"{root}/raw", landed, f"{root}/landed", multi_line=True)
        jobs.export_purchases(spark, landed, f"{root}/export")
        writers.write_parquet(reviews_union(spark, sf_dir), f"{root}/reviews")
        writers.write_parquet(inputs.logs(spark, sf_dir), f"{root}/logs")
        given = ([f"{root}/reviews"], f"{root}/logs", mart, LOAD_TS)
        jobs.build_facts(spark, landed, *given, purchases_format="table")
        jobs.build_facts(spark, f"{root}/export", *given, multi_line=True)
        spark.sql(f"DROP TABLE {landed}")
    return tables.read_table(spark, mart.table("fct_users")).drop("insert_date")


def mart_from_text_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts over logs that got their ids from their place in the files."""
    place = scratch_path(spark, "mart")
    mart = jobs.Warehouse(_table_name("mart"), location=f"{place}/tables")
    spark.sql(f"CREATE DATABASE {mart.database} LOCATION '{place}/database'")
    with scratch_folder(spark, "mart-files") as root:
        _write_log_text(spark, sf_dir, f"{root}/raw-logs", pretty=True)
        jobs.stage_logs(spark, f"{root}/raw-logs", f"{root}/logs", "text")
        jobs.build_dims(spark, f"{root}/logs", mart)
        writers.write_parquet(inputs.purchases(spark, sf_dir), f"{root}/purchases")
        writers.write_parquet(reviews_union(spark, sf_dir), f"{root}/reviews")
        jobs.build_facts(
            spark, f"{root}/purchases", [f"{root}/reviews"], f"{root}/logs", mart, LOAD_TS,
            purchases_format="parquet",
        )
    return tables.read_table(spark, mart.table("fct_movie_analytics"))


def queries() -> dict[str, Query]:
    return {
        "load_purchases": load_purchases,
        "purchases_row_count": purchases_row_count,
        "export_purchases": export_purchases,
        "read_reviews_csv": read_reviews_csv,
        "review_value_counts": review_value_counts,
        "review_tokens": review_tokens,
        "stage_reviews": stage_reviews,
        "stage_reviews_stopword": stage_reviews_stopword,
        "stage_reviews_span": stage_reviews_span,
        "reviews_preview": reviews_preview,
        "reviews_union": reviews_union,
        "stage_logs_csv": stage_logs_csv,
        "stage_logs_text": stage_logs_text,
        "stage_logs_text_spread": stage_logs_text_spread,
        "stage_logs_text_odd": stage_logs_text_odd,
        "stage_logs_xml": stage_logs_xml,
        "split_os_browser": split_os_browser,
        **{name: _dim(plan) for name, plan in dims.DIMENSIONS.items()},
        "dim_date_table": dim_date_table,
        "season_counts_sql": season_counts_sql,
        "spend_per_customer": spend_per_customer,
        "score_per_user": score_per_user,
        "user_behavior": user_behavior,
        "fct_users": fct_users,
        "reviews_with_logs": reviews_with_logs,
        "reviews_with_repeated_logs": reviews_with_repeated_logs,
        "fct_movie_analytics": fct_movie_analytics,
        "fct_movie_analytics_hot_keys": fct_movie_analytics_hot_keys,
        "mart_from_files": mart_from_files,
        "mart_from_text_logs": mart_from_text_logs,
        "mart_line_breaks": mart_line_breaks,
    }
