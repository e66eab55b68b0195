"""Declared schemas.  Nothing in the library infers a schema from data.

Review and log ids are ``bigint``: a log table with more than 2^31 rows must
still be numbered without overflow.
"""

from __future__ import annotations

from pyspark.sql import types as T

PURCHASES = T.StructType(
    [
        T.StructField("invoice_number", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("unit_price", T.DecimalType(8, 3)),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("country", T.StringType()),
    ]
)

RAW_REVIEWS = T.StructType(
    [
        T.StructField("cid", T.IntegerType()),
        T.StructField("review_str", T.StringType()),
        T.StructField("id_review", T.LongType()),
    ]
)

STAGED_REVIEWS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("positive_review", T.IntegerType()),
        T.StructField("review_id", T.LongType()),
    ]
)

# The children of one <log> element.
LOG_RECORD = T.StructType(
    [
        T.StructField("device", T.StringType()),
        T.StructField("ipAddress", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("logDate", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("phoneNumber", T.StringType()),
    ]
)

# One line of a log file that carries its own id next to the XML text.
RAW_LOGS = T.StructType(
    [
        T.StructField("id_review", T.LongType()),
        T.StructField("log", T.StringType()),
    ]
)

STAGED_LOGS = T.StructType(
    [*LOG_RECORD.fields, T.StructField("id_review", T.LongType())]
)

AMOUNT = T.DecimalType(29, 3)


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
