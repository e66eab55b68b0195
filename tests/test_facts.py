from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from reviewmart.plans import facts
from reviewmart.plans.staging import preview, reviews_union, split_os_browser
from reviewmart.quality import row_count
from reviewmart.schemas import PURCHASES, STAGED_LOGS, STAGED_REVIEWS
from conftest import plan_text


def purchases(spark, rows):
    """Purchases from (customer, quantity, price)."""
    return spark.createDataFrame(
        [("i", "s", "d", q, dt.datetime(2021, 1, 1), p and Decimal(p), c, "x")
         for c, q, p in rows],
        PURCHASES,
    )


def reviews(spark, rows):
    return spark.createDataFrame(rows, STAGED_REVIEWS)


def logs(spark, rows):
    return split_os_browser(
        spark.createDataFrame(
            [("d", "ip", loc, "04-25-2021", "Apple iOS", "p", i) for i, loc in rows],
            STAGED_LOGS,
        )
    )


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


BUYS = [
    (1, 2, "2.550"), (1, -1, "1.000"), (1, None, "9.000"), (None, 5, "5.000"),
    (2, None, "1.000"), (3, 2_000_000_000, "99999.999"), (3, 1, "0.001"), (4, 1, "0.100"),
]
STAGED = [(1, 1, 10), (1, 0, 11), (None, 1, 12), (None, 1, 13), (9, 1, 14), (4, 0, 15)]


def test_spend(spark):
    spend = facts.spend_per_customer(purchases(spark, BUYS))
    assert spend.dtypes == [("customer_id", "int"), ("amount_spent", "decimal(29,3)")]
    assert dict(spend.collect()) == {
        1: Decimal("4.100"),
        2: None,
        3: Decimal("199999998000000.001"),
        4: Decimal("0.100"),
    }


def test_score_of_unknown_reviewers_counts_no_id(spark):
    score = facts.score_per_user(reviews(spark, STAGED))
    assert bag(score.select("user_id", "review_score", "review_count")) == bag_of(
        [(1, 1, 2), (None, 2, 0), (9, 1, 1), (4, 0, 1)]
    )


def bag_of(rows):
    return sorted(rows, key=repr)


def test_union_folds_within_and_across(spark):
    a = reviews(spark, [(1, 1, 10), (1, 1, 10), (2, 0, 11), (None, 0, 12)])
    b = reviews(spark, [(1, 1, 10), (2, 1, 11), (None, 0, 12)]).select(
        "review_id", "user_id", "positive_review"
    )
    assert bag(reviews_union(a, b)) == bag_of(
        [(1, 1, 10), (2, 0, 11), (2, 1, 11), (None, 0, 12)]
    )
    assert bag(reviews_union(a)) == bag_of([(1, 1, 10), (2, 0, 11), (None, 0, 12)])


def test_fct_users(spark):
    stamp = dt.datetime(2024, 5, 6, 7, 8, 9)
    users = facts.fct_users(purchases(spark, BUYS), reviews(spark, STAGED), stamp)
    assert users.columns == [
        "customer_id", "amount_spent", "review_count", "review_score", "insert_date",
    ]
    assert dict(users.dtypes)["insert_date"] == "timestamp"
    assert bag(users.drop("insert_date")) == bag_of(
        [
            (1, Decimal("4.100"), 2, 1),
            (2, None, None, None),
            (3, Decimal("199999998000000.001"), None, None),
            (4, Decimal("0.100"), 1, 0),
        ]
    )
    assert {r.insert_date for r in users.collect()} == {stamp}


def test_load_time_is_now_by_default(spark):
    before = dt.datetime.now()
    users = facts.fct_users(purchases(spark, BUYS), reviews(spark, STAGED))
    stamps = {r.insert_date for r in users.collect()}
    assert len(stamps) == 1 and before <= stamps.pop() <= dt.datetime.now()


@pytest.mark.parametrize("min_hot", [1, 1_000_000])
def test_fct_movie_analytics(spark, min_hot):
    r = reviews(spark, STAGED)
    users = facts.user_behavior(purchases(spark, BUYS), r)
    some = logs(spark, [(10, "a"), (10, "b"), (12, "c"), (15, "d"), (99, "e"), (None, "f")])
    fact = facts.fct_movie_analytics(r, some, users, min_hot)
    assert fact.columns == [
        "review_id", "user_id", "logDate", "device", "location", "os", "browser",
        "amount_spent", "review_count", "review_score",
    ]
    log = lambda loc: ("04-25-2021", "d", loc, "iOS", "Apple")
    no_log, no_user = (None,) * 5, (None,) * 3
    one = (Decimal("4.100"), 2, 1)
    assert bag(fact) == bag_of(
        [
            (10, 1, *log("a"), *one),
            (10, 1, *log("b"), *one),
            (11, 1, *no_log, *one),
            (12, None, *log("c"), *no_user),
            (13, None, *no_log, *no_user),
            (14, 9, *no_log, *no_user),
            (15, 4, *log("d"), Decimal("0.100"), 1, 0),
        ]
    )
    both = facts.reviews_with_logs(r, some, min_hot)
    assert both.columns == [
        "review_id", "user_id", "positive_review",
        "logDate", "device", "location", "os", "browser",
    ]
    assert bag(both) == bag_of(
        [
            (10, 1, 1, *log("a")),
            (10, 1, 1, *log("b")),
            (11, 1, 0, *no_log),
            (12, None, 1, *log("c")),
            (13, None, 1, *no_log),
            (14, 9, 1, *no_log),
            (15, 4, 0, *log("d")),
        ]
    )


def test_row_count_and_preview(spark):
    r = reviews(spark, STAGED)
    assert row_count(r).collect() == [(6,)]
    assert row_count(r.limit(0)).collect() == [(0,)]
    first = preview(r, "review_id", 2)
    assert list(map(tuple, first.collect())) == [(1, 1, 10), (1, 0, 11)]


def test_user_behavior_shuffles_once_per_input(spark, tmp_path, conf):
    """The two aggregates' shuffles serve the join; purchases prune and filter."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    purchases(spark, BUYS).write.parquet(str(tmp_path / "p"))
    reviews(spark, STAGED).write.parquet(str(tmp_path / "r"))
    p = spark.read.schema(PURCHASES).parquet(str(tmp_path / "p"))
    r = spark.read.schema(STAGED_REVIEWS).parquet(str(tmp_path / "r"))
    plan = plan_text(facts.user_behavior(p, r))
    assert plan.count("Arguments: hashpartitioning") == 2
    assert "SinglePartition" not in plan and "Python" not in plan
    assert "PushedFilters: [IsNotNull(customer_id)]" in plan
    assert "ReadSchema: struct<quantity:int,unit_price:decimal(8,3),customer_id:int>" in plan
