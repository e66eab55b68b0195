"""The raw files that queries make of the given tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewmart import session
from reviewmart.checks import queries


@pytest.fixture
def given(spark, tmp_path):
    orders = spark.range(200).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 7).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit("1-URGENT").alias("o_orderpriority"),
        F.lit("2024-01-02").cast("date").alias("o_orderdate"),
    )
    lines = spark.range(600).select(
        (F.col("id") % 200).alias("l_orderkey"),
        F.col("id").alias("l_partkey"),
        F.lit("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.lit(3.0).alias("l_quantity"),
        F.lit(12.5).alias("l_extendedprice"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_shuffles_that_make_the_raw_purchases_grow_with_the_tables(spark, given, monkeypatch):
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", 100)
    original, seen = queries.writers.write_csv, []

    def write(df, path):
        seen.append(int(spark.conf.get(session.INITIAL, "0")))
        original(df, path)

    monkeypatch.setattr(queries.writers, "write_csv", write)
    rows = queries.load_purchases(spark, given)
    assert rows.count() == 600 and rows.where("quantity = 3").count() == 600
    stored = session.stored_bytes(spark, [f"{given}/orders.parquet", f"{given}/lineitem.parquet"])
    assert seen[0] >= stored // 100
    assert spark.conf.get(session.INITIAL, None) is None
