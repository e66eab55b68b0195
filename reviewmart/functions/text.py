"""Review text: tokens, stop words and the keyword flag.

Everything is built-in column functions, so a review never leaves the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmart.functions.stopwords import ENGLISH

# What Java's \s matches; tokens are cut at each one of these.
WHITESPACE = " \t\n\x0b\f\r"


def tokens(text: Column) -> Column:
    """Lower-case and cut at every whitespace character.

    Empty tokens at the end are dropped, those at the start and inside stay;
    the empty text has one empty token.  NULL gives NULL.
    """
    # Trimming walks the whole text, so look at its end first.
    open_end = reduce(or_, (F.endswith(text, F.lit(c)) for c in WHITESPACE))
    trimmed = F.rtrim(text, F.lit(WHITESPACE))
    body = F.when(open_end, trimmed).otherwise(text)
    return F.when(open_end & (trimmed == ""), F.array().cast("array<string>")).otherwise(
        F.split(F.lower(body), r"\s")
    )


def remove_stop_words(
    words: Column, stop_words: Iterable[str] = ENGLISH, lower_case: bool = False
) -> Column:
    """Drop whole tokens found in ``stop_words``, ignoring case.

    ``lower_case`` says that the words are so already, as ``tokens`` are.
    """
    banned = sorted({w.lower() for w in stop_words})
    if not banned:
        return words
    if lower_case:
        return F.filter(words, lambda t: ~t.isin(*banned))
    return F.filter(words, lambda t: ~F.lower(t).isin(*banned))


def keyword_flag(
    text: Column, keyword: str, stop_words: Iterable[str] = ENGLISH
) -> Column:
    """Whether ``keyword`` occurs in the text left after stop-word removal.

    The text left over is its tokens joined by commas, and the keyword is a
    plain case-sensitive substring of that.  NULL text gives false.

    Only a keyword with a comma can span two tokens, so every other keyword is
    decided on the raw text without building the token array:

    * no stop word contains it: removing stop words cannot remove it;
    * some do: one regex finds a token that holds it and is none of those.

    Texts without the keyword, or without a piece of it between commas, are
    told by a substring test and go no further.
    """
    banned = sorted({w.lower() for w in stop_words})
    lowered = F.lower(text)
    holders = [w for w in banned if keyword in w and not set(w) & set(WHITESPACE)]
    if keyword == "":
        hit = text.isNotNull()
    elif any(c in WHITESPACE for c in keyword):
        hit = F.lit(False)
    else:
        pieces = [piece for piece in keyword.split(",") if piece]
        hit = reduce(and_, (F.contains(lowered, F.lit(p)) for p in pieces), F.lit(True))
        if "," in keyword:
            kept = remove_stop_words(tokens(text), banned, lower_case=True)
            hit = F.when(hit, F.contains(F.concat_ws(",", kept), F.lit(keyword)))
        elif holders:
            hit = hit & lowered.rlike(_token_with(keyword, holders))
    return F.coalesce(hit, F.lit(False))


def _token_with(keyword: str, holders: list[str]) -> str:
    """Regex for a token that contains ``keyword`` and is none of ``holders``."""
    either = "|".join(re.escape(w) for w in holders)
    return rf"(?:\A|\s)(?!(?:{either})(?:\s|\z))\S*{re.escape(keyword)}"
