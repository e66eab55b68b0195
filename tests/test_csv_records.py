"""Line breaks in CSV fields, read by many tasks, against Spark's own multi-line reader."""

from __future__ import annotations

import random

import pytest
from conftest import plan_text
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmart import jobs
from reviewmart.schemas import RAW_REVIEWS
from reviewmart.session import planned_bytes
from reviewmart.sources import csv, csv_records, tables

HEADER = "cid,review_str,id_review"


def field(rng: random.Random) -> str:
    pieces = ["a", "b c", "\n", "\r\n", '""', ",", "é", "\\", "\n\n", " ", "x" * 30, '"",""']
    text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
    return f'"{text}"'


def content(seed: int, n: int, end: str) -> str:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([field(rng), field(rng), "plain text", "", '""', " spaced "])
        rows.append(f"{rng.choice([i, ''])},{text},{i}")
        rows += [""] * (rng.random() < 0.1)
    return end.join([HEADER, *rows]) + rng.choice(["", end])


def spark_reads(spark, path):
    reader = spark.read.options(**csv.DIALECT).option("multiLine", True).schema(RAW_REVIEWS)
    return reader.csv(path)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("broadcast", [csv_records.MAX_BROADCAST_BYTES, 0])
def test_equals_the_multi_line_reader_with_small_splits(spark, tmp_path, conf, monkeypatch, end, broadcast):
    original = csv_records.csv_records
    monkeypatch.setattr(csv, "csv_records", lambda *a, **k: original(*a, **k, max_broadcast=broadcast))
    for i in range(6):
        # Small splits, so that records, and quoted stretches of many lines, lie over several.
        text = content(i, 60, end)
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
    (tmp_path / "6.csv").write_bytes(("﻿" + content(6, 20, end)).encode())
    (tmp_path / "7.csv").write_bytes(f'{HEADER}{end}1,"{"line" + end}{(end + "more") * 400}",2'.encode())
    (tmp_path / "8.csv").write_bytes(b"")
    due = bag(spark_reads(spark, str(tmp_path)))
    conf(spark__sql__files__maxPartitionBytes="256", spark__sql__files__openCostInBytes="1")
    found = csv.read_reviews(spark, str(tmp_path), multi_line=True)
    assert bag(found) == due
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 20


def test_records_are_numbered_in_their_file(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="8", spark__sql__files__openCostInBytes="1")
    (tmp_path / "a.csv").write_text('h\n1\n"2\n\n2"\n\n3\n')
    found = csv_records.csv_records(spark, [str(tmp_path)]).select("record", "text")
    assert bag(found) == [(0, "h"), (1, "1"), (2, '"2\n\n2"'), (4, "3")]


def test_headers_may_run_over_lines_and_must_agree(spark, tmp_path):
    schema = T.StructType([T.StructField("a\nb", T.StringType()), T.StructField("c", T.IntegerType())])
    (tmp_path / "1.csv").write_text('"a\nb",c\n"x\ny",1\n')
    (tmp_path / "2.csv").write_text('"A\nB","c"\nz,2\n')
    assert bag(csv.read_csv(spark, str(tmp_path), schema, multi_line=True)) == [("x\ny", 1), ("z", 2)]
    (tmp_path / "3.csv").write_text('c,"a\nb"\n1,z\n')
    with pytest.raises(ValueError, match="another header"):
        csv.read_csv(spark, str(tmp_path), schema, multi_line=True)
    # By position the header is skipped, whatever it says.
    assert len(bag(csv.read_csv(spark, str(tmp_path), schema, True, by_name=False))) == 3
    (tmp_path / "4.csv").write_text('\n"a\nb",c\n1,2\n')
    with pytest.raises(ValueError, match="another header"):
        csv.read_csv(spark, str(tmp_path), schema, True, by_name=False)


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ('1,"never closed,2\n3,x,4\n', "end inside a quoted field"),
        ('1,5" wide,2\n3,7" wide,4\n', "without quotes"),
        ('1, "a\nb",2\n', "without quotes"),
        ('1,"a\nb"c,2\n', "without quotes"),
        ('1,"a\nb"\n', "(?i)number of fields"),
        ('1,"a\nb",2,3\n', "(?i)number of fields"),
    ],
)
def test_broken_files_are_errors(spark, tmp_path, rows, message):
    (tmp_path / "r.csv").write_text(f"{HEADER}\n0,good,0\n{rows}")
    with pytest.raises(Exception, match=message):
        csv.read_reviews(spark, str(tmp_path), multi_line=True).collect()


def test_a_record_too_large_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_records, "MAX_RECORD_BYTES", 1000)
    (tmp_path / "r.csv").write_text(f'{HEADER}\n1,"{"word " * 100}\n",2\n')
    assert csv.read_reviews(spark, str(tmp_path), multi_line=True).count() == 1
    (tmp_path / "r.csv").write_text(f'{HEADER}\n1,"{"word " * 300}\n",2\n')
    with pytest.raises(ValueError, match="not to be closed"):
        csv.read_reviews(spark, str(tmp_path), multi_line=True)


def test_values_that_do_not_parse(spark, tmp_path):
    (tmp_path / "r.csv").write_text(f'{HEADER}\nx,"a\nb",1\n2,"c\nd",\n')
    assert bag(csv.read_reviews(spark, str(tmp_path), True)) == [(2, "c\nd", None), (None, "a\nb", 1)]
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_csv(spark, str(tmp_path), RAW_REVIEWS, True, strict=True).collect()


def test_no_python_and_no_single_task_in_the_plan(spark, tmp_path):
    (tmp_path / "r.csv").write_text(f'{HEADER}\n1,"a\nb",2\n')
    plan = plan_text(csv.read_reviews(spark, str(tmp_path), multi_line=True))
    assert "Python" not in plan and "SinglePartition" not in plan


def test_table_sizes_come_from_the_plan(spark, tmp_path):
    path = tmp_path / "sized"
    spark.range(100_000).write.saveAsTable("sized_by_plan", path=str(path))
    stored = sum(p.stat().st_size for p in path.glob("*.parquet"))
    assert 0.5 * stored < planned_bytes(spark.table("sized_by_plan")) < 2 * stored


@pytest.mark.parametrize("multi_line", [True, False])
def test_what_does_not_parse_is_counted_as_it_is_written(spark, tmp_path, multi_line):
    lines = ["1,good,2", "x,good,3", ",bad,4", "5,,6.5", "y,,z", "6,\"a, b\",7"]
    (tmp_path / "r.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    found = jobs.stage_reviews(spark, str(tmp_path / "r.csv"), str(tmp_path / "out"), multi_line=multi_line)
    assert found == {"rows": 6, "odd_rows": 3, "nulled_cid": 2, "nulled_id_review": 2}
    (tmp_path / "r.csv").write_text(HEADER + "\n")
    found = jobs.stage_reviews(spark, str(tmp_path / "r.csv"), str(tmp_path / "out"), multi_line=multi_line)
    assert found == {"rows": 0, "odd_rows": 0, "nulled_cid": 0, "nulled_id_review": 0}


def test_a_staged_table_without_a_column_is_an_error(spark, tmp_path):
    path = str(tmp_path / "staged")
    spark.range(3).select(F.col("id").alias("review_id"), F.lit(1).alias("USER_ID")).write.parquet(path)
    with pytest.raises(ValueError, match="positive_review"):
        tables.read_staged_reviews(spark, path)
    # Another file has it: the older rows have none.
    spark.range(2).select(F.lit(1).alias("positive_review")).write.mode("append").parquet(path)
    assert tables.read_staged_reviews(spark, path).where("positive_review IS NULL").count() == 3


def test_lines_are_neither_sorted_nor_shuffled_to_find_records(spark, tmp_path, monkeypatch):
    (tmp_path / "r.csv").write_text(content(1, 50, "\n"))
    staged, original = {}, csv_records.stage

    def seen(df, label, *args, **kwargs):
        staged[label] = plan_text(df)
        return original(df, label, *args, **kwargs)

    monkeypatch.setattr(csv_records, "stage", seen)
    due = bag(spark_reads(spark, str(tmp_path)))
    assert bag(csv.read_reviews(spark, str(tmp_path), multi_line=True)) == due
    text = next(p for p in staged.values() if "Scan text" in p)
    assert "Exchange" not in text and "Sort" not in text


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [1, 40, 300])
def test_chunks_of_any_size_give_the_same_records(spark, tmp_path, monkeypatch, conf, end, size):
    monkeypatch.setattr(csv_records, "CHUNK_BYTES", size)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_bytes(content(10 + i, 80, end).encode())
    due = bag(spark_reads(spark, str(tmp_path)))
    conf(
        spark__sql__files__maxPartitionBytes="500",
        spark__sql__files__openCostInBytes="1",
        spark__sql__execution__arrow__maxRecordsPerBatch="7",
    )
    assert bag(csv.read_reviews(spark, str(tmp_path), multi_line=True)) == due


def test_many_quotes_in_one_record(spark, tmp_path):
    text = '""' * 300_000 + "\n" + '"",""' * 100_000
    (tmp_path / "r.csv").write_text(f'{HEADER}\n1,"{text}",2\n')
    found = csv.read_reviews(spark, str(tmp_path), multi_line=True).select(F.length("review_str")).first()
    assert found[0] == len(text.replace('""', '"'))
