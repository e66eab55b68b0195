"""Staged reviews and enriched logs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.logs import browser_of, os_of
from reviewmart.functions.stopwords import ENGLISH
from reviewmart.functions.text import keyword_flag, remove_stop_words, tokens

DEFAULT_KEYWORD = "good"


def review_tokens(reviews: DataFrame, stop_words: Iterable[str] = ENGLISH) -> DataFrame:
    """Raw reviews with their tokens, before and after stop-word removal."""
    words = reviews.withColumn("review_token", tokens(F.col("review_str")))
    kept = remove_stop_words(F.col("review_token"), stop_words, lower_case=True)
    return words.withColumn("review_token_sw", kept)


def flags_as_int(df: DataFrame, *flags: str) -> DataFrame:
    """Each boolean column as 0 or 1, in place."""
    return df.withColumns({f: F.col(f).cast("int") for f in flags})


def staged_reviews(
    reviews: DataFrame,
    keyword: str = DEFAULT_KEYWORD,
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """One narrow row per raw review.  No shuffle."""
    flag = keyword_flag(F.col("review_str"), keyword, stop_words)
    flagged = reviews.select(
        F.col("cid").alias("user_id"),
        flag.alias("positive_review"),
        F.col("id_review").alias("review_id"),
    )
    return flags_as_int(flagged, "positive_review")


def preview(df: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first rows by ``key``; rows with equal keys follow their other columns."""
    rest = [c for c in df.columns if c != key]
    return df.orderBy(key, *rest).limit(rows)


def reviews_union(*parts: DataFrame) -> DataFrame:
    """Distinct staged reviews of all parts.

    Duplicates fold within each task before the shuffle, so many copies of a
    row do not gather in one place.
    """
    return reduce(DataFrame.unionByName, parts).distinct()


def split_os_browser(logs: DataFrame, contact: bool = False) -> DataFrame:
    """Cut ``os`` into operating system and browser.

    IP address and phone number reach no table of the mart, so they are left
    out, and not read, unless ``contact`` asks for them.
    """
    agent = F.col("os")
    return logs.select(
        "id_review",
        "device",
        *(["ipAddress"] if contact else []),
        "location",
        "logDate",
        os_of(agent).alias("os"),
        *(["phoneNumber"] if contact else []),
        browser_of(agent).alias("browser"),
    )
