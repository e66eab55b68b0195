"""The mart's inputs, made from whole given tables.

========================  =====================================================
input                     made from
========================  =====================================================
purchases                 lineitem and its order; no customer is known where the
                          order priority is "4-NOT SPECIFIED"
reviews                   documents; the reviewer of Spanish texts is unknown
reviews (2nd delivery)    conversations; the system's own turns have no reviewer
review logs               orders; the agent has one, two or three words
========================  =====================================================

Three neighbouring ids share a reviewer, so reviewers repeat, and some have no
purchases.  Review ids go further than log ids, so some reviews have no log.
The two deliveries use the same ids, so rows repeat within and across them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.schemas import LOG_RECORD, PURCHASES


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "CAST(l_orderkey AS STRING) AS invoice_number",
        "CAST(l_partkey AS STRING) AS stock_code",
        "concat(l_returnflag, ' ', l_linestatus) AS detail",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS invoice_date",
        "CAST(CAST(l_extendedprice AS DECIMAL(10, 2)) * 0.1BD AS DECIMAL(8, 3))"
        " AS unit_price",
        "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'"
        " THEN CAST(o_custkey AS INT) END AS customer_id",
        "o_orderstatus AS country",
    ).select(*PURCHASES.names)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "CASE WHEN lang <> 'es' THEN CAST(doc_id DIV 3 * 5 AS INT) END AS cid",
        "text AS review_str",
        "doc_id * 20 AS id_review",
    )


def more_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(
        "CASE WHEN role <> 'system' THEN CAST(conv_id DIV 3 * 5 AS INT) END AS cid",
        "text AS review_str",
        "conv_id * 20 AS id_review",
    )


def logs(spark: SparkSession, sf_dir: str, row_id: str = "o_orderkey") -> DataFrame:
    """Staged logs; ``row_id`` is the SQL of their id."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS device",
        "concat('10.0.0.', o_custkey) AS ipAddress",
        "concat('store <', o_custkey, '> & co') AS location",
        "date_format(o_orderdate, 'MM-dd-yyyy') AS logDate",
        "CASE WHEN o_orderstatus = 'P' THEN concat(o_orderpriority, ' P')"
        " ELSE o_orderpriority END AS os",
        "CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS STRING) END"
        " AS phoneNumber",
        f"{row_id} AS id_review",
    )


def log_xml(staged_logs: DataFrame, pretty: bool = False) -> DataFrame:
    """``id_review`` and the ``<log>`` element of each staged log."""
    options = {"rowTag": "log"} if pretty else {"rowTag": "log", "indent": ""}
    element = F.to_xml(F.struct(*LOG_RECORD.names), options)
    return staged_logs.select("id_review", F.trim(element, F.lit("\n")).alias("log"))
