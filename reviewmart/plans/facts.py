"""Fact tables: spend and review score per customer, one rich row per review."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.operators.joins import hot_key_parts, left_join
from reviewmart.schemas import AMOUNT

BEHAVIOR = ("customer_id", "amount_spent", "review_count", "review_score")
LOG_ATTRIBUTES = ("logDate", "device", "location", "os", "browser")


def spend_per_customer(purchases: DataFrame) -> DataFrame:
    """Exact decimal spend of each known customer."""
    amount = F.sum(F.col("quantity") * F.col("unit_price")).cast(AMOUNT)
    known = purchases.where(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(amount.alias("amount_spent"))


def score_per_user(reviews: DataFrame) -> DataFrame:
    """Flag sum and review count of each reviewer.

    The count is of non-null ids: the group of unknown reviewers has count 0.
    """
    return reviews.groupBy("user_id").agg(
        F.sum("positive_review").alias("review_score"),
        F.count("user_id").alias("review_count"),
    )


def user_behavior(purchases: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per customer with purchases; reviewers without any are left out.

    Both sides have one row per key and are already partitioned by it, so the
    join adds no shuffle and no key is hot.
    """
    spend = spend_per_customer(purchases)
    score = score_per_user(reviews)
    same = spend.customer_id == score.user_id
    return spend.join(score, same, "left").select(*BEHAVIOR)


def fct_users(
    purchases: DataFrame, reviews: DataFrame, load_ts: datetime | None = None
) -> DataFrame:
    """``user_behavior`` stamped with the load time, now by default."""
    stamp = F.current_timestamp() if load_ts is None else F.lit(load_ts)
    return user_behavior(purchases, reviews).withColumn("insert_date", stamp)


def reviews_with_logs(
    reviews: DataFrame, logs: DataFrame, min_hot_rows: int | None = None
) -> DataFrame:
    """Each review with its logs, if any.  Takes enriched logs.

    Looks for hot ids on both sides first, so pass written tables.
    """
    joined = left_join(
        reviews,
        logs.select("id_review", *LOG_ATTRIBUTES),
        "review_id",
        "id_review",
        hot_key_parts(reviews, "review_id", min_rows=min_hot_rows)["review_id"],
        hot_key_parts(logs, "id_review", min_rows=min_hot_rows)["id_review"],
    )
    return joined.select("review_id", "user_id", "positive_review", *LOG_ATTRIBUTES)


def fct_movie_analytics(
    reviews: DataFrame,
    logs: DataFrame,
    users: DataFrame,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """One row per review and matching log, with its reviewer's totals.

    Users are joined before logs: the wide log attributes are then shuffled
    once, not twice.  ``users`` has one row per customer, so it multiplies no
    rows and its keys need no look.  Pass written reviews and logs, as their
    keys are looked at first.
    """
    hot = hot_key_parts(reviews, "user_id", "review_id", min_rows=min_hot_rows)
    hot_logs = hot_key_parts(logs, "id_review", min_rows=min_hot_rows)
    with_users = left_join(
        reviews.select("review_id", "user_id"),
        users.select(*BEHAVIOR),
        "user_id",
        "customer_id",
        hot["user_id"],
    )
    joined = left_join(
        with_users.drop("customer_id"),
        logs.select("id_review", *LOG_ATTRIBUTES),
        "review_id",
        "id_review",
        hot["review_id"],
        hot_logs["id_review"],
    )
    return joined.select("review_id", "user_id", *LOG_ATTRIBUTES, *BEHAVIOR[1:])
