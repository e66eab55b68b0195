"""The registered queries and the pipeline on the smallest given tables."""

from __future__ import annotations

import os

import corpus_pipeline
import duckdb
import pytest

from reviewmart.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_against_sql(spark, name):
    found = queries.queries()[name](spark, SF)
    with duckdb.connect() as db:
        for table in os.listdir(SF):
            db.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM '{SF}/{table}'")
        result = db.execute(oracle.oracle_sql()[name])
        names = [x[0] for x in result.description]
        due = [tuple(r[names.index(c)] for c in found.columns) for r in result.fetchall()]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(due, key=str)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = corpus_pipeline.quality_classifier(spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    good = [d for d, q in quality.items() if q == 1]
    assert sum(d in ids for d in good) >= 0.97 * len(good)
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.collect()} <= ids


def test_quality_rejects_labelled_documents(spark):
    sf = SF.replace("0.001", "0.1")
    judged = queries.queries()["op2_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    bad = [r["accepted"] for r in judged.where("quality = 0").select("accepted").collect()]
    assert sum(not x for x in bad) >= 0.95 * len(bad) > 500
