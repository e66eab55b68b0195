"""What must hold between the mart's tables, on the smallest data set."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from reviewmart.checks import inputs, queries
from reviewmart.plans.dims import DIMENSIONS
from reviewmart.sources.tables import read_staged_logs, read_staged_reviews

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_numbering_is_a_permutation(spark):
    n = inputs.logs(spark, SF_DIR).count()
    ids = queries.stage_logs_text(spark, SF_DIR).select("id_review")
    low, high, distinct = ids.agg(
        F.min("id_review"), F.max("id_review"), F.countDistinct("id_review")
    ).first()
    assert (low, high, distinct, ids.count()) == (1, n, n, n)


def test_dimensions_have_one_row_per_log(spark):
    n = inputs.logs(spark, SF_DIR).count()
    for name in DIMENSIONS:
        assert queries.queries()[name](spark, SF_DIR).count() == n, name


def test_fact_has_one_row_per_distinct_review(spark):
    reviews = queries.reviews_union(spark, SF_DIR)
    fact = queries.fct_movie_analytics(spark, SF_DIR)
    assert fact.count() == reviews.count() == reviews.distinct().count()


def test_users_are_customers_and_keep_the_total(spark):
    users = queries.fct_users(spark, SF_DIR)
    assert users.count() == users.select("customer_id").distinct().count()
    bought = inputs.purchases(spark, SF_DIR).where("customer_id IS NOT NULL")
    direct = bought.agg(F.sum(F.expr("quantity * unit_price"))).first()[0]
    assert users.agg(F.sum("amount_spent")).first()[0] == direct


def test_staged_tables_with_narrow_ids_can_be_read(spark, tmp_path):
    reviews, logs = str(tmp_path / "r"), str(tmp_path / "l")
    spark.sql("SELECT 1 AS user_id, 0 AS positive_review, 7 AS review_id").write.parquet(
        reviews
    )
    staged = inputs.logs(spark, SF_DIR)
    staged.withColumn("id_review", F.col("id_review").cast("int")).write.parquet(logs)
    assert read_staged_reviews(spark, reviews).collect() == [(1, 0, 7)]
    got = read_staged_logs(spark, logs)
    assert dict(got.dtypes)["id_review"] == "bigint"
    assert got.exceptAll(staged).count() == 0 and got.count() == staged.count()
