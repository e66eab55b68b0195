"""The operators as queries over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm import (
    align_tokens,
    byte_bpe,
    decontaminate,
    hard_negatives,
    jaccard_join,
    packing,
    pii,
    quality,
    substring_dedup,
    suffix_dedup,
    token_store,
    topk,
    url_filter,
)
from reviewmart.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

RULES = (
    url_filter.Rule("allow", "org"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_HOSTS = [f"{x}.example.{top}" for x in BLOCKED_NAMES for top in ("com", "net", "org")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(pii.examples(spark)))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, trusted_ids(spark, sf_dir), ["doc_id", "lang"])


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors that are null, or hold null or non-finite components, take no part."""
    rows = _table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "CAST(embedding AS ARRAY<DOUBLE>) e"
    )
    finite = "e IS NOT NULL AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    vectors = rows.where(finite).selectExpr(
        "vec_id", "filter(transform(e, (x, i) -> struct(bigint(i) AS t, floor(1024 * x) AS w)), s -> s.w <> 0) s"
    ).selectExpr("vec_id", "s.t AS terms", "s.w AS weights")
    queries = vectors.where(F.col("vec_id") % 100 == 0)
    return topk.top_k(queries, vectors, 10)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path, TOKENIZER, last_id=2)
    return token_store.describe_tokens(spark, path)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.strip_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.strip_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = spark.createDataFrame([(x,) for x in BLOCKED_HOSTS], "entry string")
    name = url_filter.ship_list(spark, blocked)
    return url_filter.judge(_table(spark, sf_dir, "pages"), RULES, name)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontaminate.contained(_table(spark, sf_dir, "documents"), benchmark)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, last_id=0, limit=2048)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors that are null, or hold null or non-finite components, take no part."""
    finite = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    rows = _table(spark, sf_dir, "embeddings").where(f"label IS NOT NULL AND {finite}").selectExpr(
        "vec_id",
        "IF(vec_id % 7 = 0, (label + 1) % 10, label) label",
        "transform(embedding, x -> floor(256 * CAST(x AS DOUBLE))) vector",
    )
    return hard_negatives.mine(rows.where("vec_id % 100 = 0"), rows, 5, 10, 30, 90)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_bpe.describe(docs, BYTE_RANKS, public_tokenizers.PATTERN)


def op13_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens.describe(_table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)


def queries() -> dict[str, Query]:
    found = [
        op1_pii,
        op2_quality,
        op3_topk,
        op4_token_store,
        op5_substring_dedup,
        op6_suffix_dedup,
        op7_url_filter,
        op8_jaccard_join,
        op9_decontaminate,
        op10_packing,
        op11_hard_negatives,
        op12_byte_bpe,
        op13_align_tokens,
    ]
    return {query.__name__: query for query in found}
