"""Tables that several sessions write, and readers that are under way."""

from __future__ import annotations

import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reviewmart import jobs
from reviewmart.schemas import PURCHASES
from reviewmart.sinks import versions, writers
from reviewmart.sources import tables

OTHER = """
import sys
from reviewmart import jobs
from reviewmart.session import build_session

spark = build_session("other", "local[1]", **{
    "spark.sql.warehouse.dir": sys.argv[1] + "/other", "spark.checkpoint.dir": sys.argv[1] + "/scratch"})
mart = jobs.Warehouse("jm", location=sys.argv[1] + "/mart")
assert not spark.catalog.databaseExists("jm")
mart.write(spark.range(int(sys.argv[2])).toDF("id"), "t")
mart.write(spark.range(int(sys.argv[2]) + 1).toDF("id"), "t")
assert spark.table("jm.t").count() == int(sys.argv[2]) + 1
"""


def new_name():
    return "t_" + uuid.uuid4().hex


def folders(place):
    return sorted(p.name for p in Path(place).iterdir() if p.is_dir())


def test_two_sessions_write_one_location(spark, tmp_path):
    root = Path(__file__).parent.parent
    for n in (10, 20):
        command = [sys.executable, "-c", OTHER, str(tmp_path), str(n)]
        subprocess.run(command, check=True, cwd=root, timeout=300)
    place = f"{tmp_path}/mart/t"
    assert tables.read_current(spark, place).count() == 21
    # A third one, whose catalog does not know the table either.
    mart = jobs.Warehouse(location=f"{tmp_path}/mart")
    name = new_name()
    (tmp_path / "mart" / "t").rename(tmp_path / "mart" / name)
    mart.write(spark.range(3).toDF("id"), name)
    assert spark.table(name).count() == tables.read_current(spark, f"{tmp_path}/mart/{name}").count() == 3
    assert len(folders(tmp_path / "mart" / name)) == 5


def test_readers_under_way_end_on_their_version(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="1k")
    name, place = new_name(), str(tmp_path / "it's a place")
    rows = spark.range(0, 20_000, 1, 8)
    writers.write_table(rows, name, options={"path": place})
    by_name, by_path = spark.table(name), tables.read_current(spark, place)
    under_way = by_path.toLocalIterator()
    first = next(under_way)
    writers.write_table(spark.range(5), name, options={"path": place})
    assert 1 + sum(1 for _ in under_way) == 20_000 and first["id"] is not None
    assert by_path.count() == 20_000 and by_name.count() in (5, 20_000)
    assert spark.table(name).count() == tables.read_current(spark, place).count() == 5


def test_a_dropped_table_is_written_again(spark, tmp_path):
    for options in ({"path": str(tmp_path / "t")}, {}):
        name = new_name()
        writers.write_table(spark.range(3), name, options=options)
        spark.sql(f"DROP TABLE {name}")
        writers.write_table(spark.range(4), name, options=options)
        assert spark.table(name).count() == 4
        spark.sql(f"DROP TABLE {name}")
        # Landing finds the rows that are there.
        writers.create_table(spark, name, spark.range(1).schema, options.get("path"))
        assert spark.table(name).count() == 4
        writers.drop_table(spark, name)
        assert not spark.catalog.tableExists(name)
    assert not (tmp_path / "t").exists()


def test_replaced_versions_go_after_their_time(spark, tmp_path):
    name, options = new_name(), {"path": str(tmp_path / "t")}
    for n in range(3):
        writers.write_table(spark.range(n), name, options=options)
    assert len(folders(tmp_path / "t")) == 3
    writers.write_table(spark.range(7), name, options=options, keep_hours=0)
    assert len(folders(tmp_path / "t")) == 1 and spark.table(name).count() == 7
    # The time counts from when a version was replaced, not from when it was written.
    pointer = versions.Versions.read(versions.Folder(spark, options["path"]))
    assert pointer.replaced == {}
    writers.write_table(spark.range(8), name, options=options, keep_hours=1)
    pointer = versions.Versions.read(versions.Folder(spark, options["path"]))
    assert len(pointer.replaced) == 1 and len(folders(tmp_path / "t")) == 2


def test_a_failing_write_leaves_pointer_and_folders(spark, tmp_path):
    name, options = new_name(), {"path": str(tmp_path / "t")}
    writers.write_table(spark.range(3), name, options=options)
    before = folders(tmp_path / "t"), (tmp_path / "t" / "_current").read_text()
    failing = spark.range(3).withColumn("x", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        writers.write_table(failing, name, options=options)
    assert before == (folders(tmp_path / "t"), (tmp_path / "t" / "_current").read_text())
    with pytest.raises(ValueError, match="no table"):
        tables.read_current(spark, str(tmp_path / "none"))


def test_landing_in_a_second_session(spark, tmp_path):
    """The catalog forgets the table, as one in memory does; loading again works."""
    (tmp_path / "p.csv").write_text(",".join(PURCHASES.names) + "\n1,s,d,2,2021-01-02 03:04:05,2.500,1,UK\n")
    name = new_name()
    for _ in range(2):
        jobs.load_purchases(spark, str(tmp_path / "p.csv"), name, location=str(tmp_path / "landed"))
        assert spark.table(name).count() == 1
        spark.sql(f"DROP TABLE {name}")
    assert tables.read_current(spark, str(tmp_path / "landed")).count() == 1


def test_a_table_whose_rows_lie_in_its_folder(spark, tmp_path):
    """As other programs write them: the rows stay, the table moves to versions below."""
    name = new_name()
    spark.range(3).write.saveAsTable(name, path=str(tmp_path / "t"))
    writers.full_refresh(spark.table(name).where("id > 0"), name)
    assert spark.table(name).count() == 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
