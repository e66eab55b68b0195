from __future__ import annotations

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from reviewmart.checks import inputs
from reviewmart.functions.stopwords import ENGLISH
from reviewmart.functions.text import keyword_flag, remove_stop_words, tokens
from reviewmart.plans.staging import review_tokens, staged_reviews

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

TEXTS = [
    "The GOOD  movie",
    "goodish",
    "not good",
    "",
    " ",
    " \t\n",
    " lead and trail ",
    "a\x0bb\x0cc\rd",
    "no-break space good em",
    "the them",
    "theatre",
    "the,them theatre",
    "THEM the\nOther",
    "x the y",
    "they'd they'd've",
    "go od",
    "İstanbul ÉTÉ ß ΣΑΣ",
    "100% _good_ \\good $1 (a|b)",
    "good,the",
    "well good the nice,one",
]


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)], "id int, review_str string"
    )


def ml_tokens(df):
    """The public ML transformers, as the independent answer."""
    cut = Tokenizer(inputCol="review_str", outputCol="tok").transform(df)
    return StopWordsRemover(inputCol="tok", outputCol="tok_sw").transform(cut)


def test_stop_words_are_the_default_list(spark):
    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_and_removal_equal_ml(spark):
    df = frame(spark, TEXTS)
    ours = df.select(
        "id",
        tokens(F.col("review_str")).alias("tok"),
        remove_stop_words(tokens(F.col("review_str"))).alias("tok_sw"),
    )
    theirs = ml_tokens(df).select("id", "tok", "tok_sw")
    assert sorted(ours.collect()) == sorted(theirs.collect())


def test_removal_ignores_case(spark):
    df = spark.createDataFrame([(["The", "the", "Thes", "", "I"],)], "w array<string>")
    assert df.select(remove_stop_words(F.col("w"))).first()[0] == ["Thes", ""]
    assert df.select(remove_stop_words(F.col("w"), [])).first()[0] == [
        "The", "the", "Thes", "", "I",
    ]


def ml_flags(df, keyword):
    joined = F.concat_ws(",", "tok_sw")
    rows = ml_tokens(df).select("id", F.contains(joined, F.lit(keyword)).alias("f"))
    return dict(rows.collect())


def our_flags(df, keyword):
    flag = keyword_flag(F.col("review_str"), keyword)
    return dict(df.select("id", flag).collect())


def test_flag_equals_ml_for_each_way_of_deciding(spark):
    df = frame(spark, TEXTS)
    for keyword in ("good", "Good", "the", "he", "'", "t", ",", "the,", "good,", "d,n",
                    "", " ", "d m", "%", "_", "\\", "$1", "(a|b)", "e,o", "é", " "):
        assert our_flags(df, keyword) == ml_flags(df, keyword), keyword


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(
        st.lists(
            st.sampled_from(["the", "them", "other", "good", "go", "od", "he", "there's",
                             " ", "\n", "\t", ",", "'", "T", "THE", "e", "\x0b"]),
            max_size=8,
        ).map("".join),
        min_size=1,
        max_size=30,
    ),
    keyword=st.sampled_from(["the", "he", "good", "e", "the,", "s", "other"]),
)
def test_flag_equals_ml_on_random_texts(spark, texts, keyword):
    df = frame(spark, texts)
    assert our_flags(df, keyword) == ml_flags(df, keyword)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_flags_and_tokens_equal_ml_on_the_given_texts(spark):
    raw = inputs.reviews(spark, SF_DIR).union(inputs.more_reviews(spark, SF_DIR))
    text, joined = F.col("review_str"), F.concat_ws(",", "tok_sw")
    differs = {"tokens": tokens(text) != F.col("tok")}
    differs["kept"] = remove_stop_words(F.col("tok")) != F.col("tok_sw")
    for keyword in ("the", "he", "s", "tion", "on,the", "n,t", "re,", "é", "not"):
        found = F.contains(joined, F.lit(keyword))
        differs[keyword] = found != keyword_flag(text, keyword)
    counts = [F.count_if(d).alias(name) for name, d in differs.items()]
    assert ml_tokens(raw).agg(*counts).first().asDict() == dict.fromkeys(differs, 0)


def test_own_stop_words_ignore_case(spark):
    df = frame(spark, ["Bad movie", "badly", "bad"])
    flag = keyword_flag(F.col("review_str"), "bad", ["BAD", "bad movie"])
    assert [r[0] for r in df.orderBy("id").select(flag).collect()] == [False, True, False]


def test_long_tokens(spark):
    df = frame(spark, ["x" * 300_000 + "the", "the " * 50_000, "th" * 200_000])
    assert our_flags(df, "the") == {0: True, 1: False, 2: False}


def test_staged_reviews_contract(spark):
    raw = spark.createDataFrame(
        [(1, "The GOOD  movie", 10), (None, "goodish", 11), (2, None, 12), (3, "", 13)],
        "cid int, review_str string, id_review bigint",
    )
    staged = staged_reviews(raw)
    assert staged.dtypes == [
        ("user_id", "int"), ("positive_review", "int"), ("review_id", "bigint"),
    ]
    assert sorted(map(tuple, staged.collect()), key=lambda r: r[2]) == [
        (1, 1, 10), (None, 1, 11), (2, 0, 12), (3, 0, 13),
    ]


def test_null_text_has_null_tokens(spark):
    row = review_tokens(frame(spark, [None])).first()
    assert row.review_token is None and row.review_token_sw is None
