"""Every registered query against its SQL, on the smallest data set."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from conftest import plan_text
from oracle_check import compare, connect
from reviewmart.checks import oracle
from reviewmart.checks import queries as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_its_sql():
    assert registered.queries().keys() == oracle.oracle_sql().keys()
    assert registered.queries().keys() <= contract.queries().keys()


# Row by row in Python, or every row against every other.
SLOW = (
    "EvalPython", "MapInPandas", "FlatMapGroups", "PythonUDF",
    "CartesianProduct", "NestedLoopJoin",
)
# Only a count of everything has to end in one task.
ONE_TASK = {"purchases_row_count"}


@pytest.mark.parametrize("name", registered.queries())
def test_query_equals_sql(spark, con, name):
    df = registered.queries()[name](spark, SF_DIR)
    plan = plan_text(df)
    assert not [word for word in SLOW if word in plan]
    assert ("SinglePartition" in plan) == (name in ONE_TASK)
    reason = compare(df, con, oracle.oracle_sql()[name])
    assert reason is None, reason


def test_inputs_reach_every_case(con):
    """The SQL checks mean something only if the inputs hold every case."""
    sql = oracle.oracle_sql()

    def count(query, condition):
        return con.execute(
            f"SELECT count(*) FROM ({sql[query]}) WHERE {condition}"
        ).fetchall()[0][0]

    assert count("load_purchases", "customer_id IS NULL") > 0
    for query in ("stage_reviews", "stage_reviews_stopword", "stage_reviews_span"):
        assert count(query, "positive_review = 1") > 0, query
        assert count(query, "positive_review = 0") > 0, query
    assert count("split_os_browser", "browser IS NULL") > 0
    assert count("split_os_browser", "browser IS NOT NULL") > 0
    for condition in (
        "device IS NULL", "device IS NOT NULL", "user_id IS NULL",
        "user_id IS NOT NULL AND amount_spent IS NULL", "amount_spent IS NOT NULL",
    ):
        assert count("fct_movie_analytics", condition) > 0, condition
    assert count("fct_users", "review_count IS NULL") > 0
    assert count("fct_users", "review_count > 1") > 0
    raw = count("read_reviews_csv", "true") + con.execute(
        "SELECT count(*) FROM conversations"
    ).fetchall()[0][0]
    assert count("reviews_union", "true") < raw


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "review_id" and df.count() > 0
