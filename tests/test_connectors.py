"""Tables behind a connector, with a stand-in one that keeps rows in a folder."""

from __future__ import annotations

import json
import os
import sys
import uuid
from dataclasses import dataclass

import pytest
from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    WriterCommitMessage,
)

from reviewmart import jobs
from reviewmart.schemas import STAGED_LOGS
from reviewmart.sinks.writers import write_parquet, write_table
from reviewmart.sources.tables import read_table


class FolderWarehouse(DataSource):
    @classmethod
    def name(cls):
        return "folder_warehouse"

    def schema(self):
        return "id bigint, name string"

    def reader(self, schema):
        return FolderReader(self.options)

    def writer(self, schema, overwrite):
        return FolderWriter(self.options, overwrite)


def file_of(options):
    return os.path.join(options["bucket"], options["table"] + ".json")


class FolderReader(DataSourceReader):
    def __init__(self, options):
        self.file = file_of(options)

    def read(self, partition):
        with open(self.file) as f:
            yield from (tuple(row) for row in json.load(f))


@dataclass
class Part(WriterCommitMessage):
    file: str


class FolderWriter(DataSourceWriter):
    def __init__(self, options, overwrite):
        assert overwrite
        self.file = file_of(options)

    def write(self, rows):
        part = f"{self.file}.{uuid.uuid4().hex}"
        with open(part, "w") as f:
            json.dump([list(r) for r in rows], f, default=str)
        return Part(part)

    def commit(self, messages):
        rows = []
        for part in messages:
            with open(part.file) as f:
                rows += json.load(f)
        with open(self.file, "w") as f:
            json.dump(rows, f)


@pytest.fixture
def connector(spark, tmp_path):
    # Tasks cannot import this file.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FolderWarehouse)
    return {"bucket": str(tmp_path)}


def test_write_replaces_and_reads_back(spark, connector):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, name string")
    for df in (rows.union(rows), rows):
        write_table(df, "mart.t", "folder_warehouse", connector)
    got = read_table(spark, "mart.t", "folder_warehouse", connector)
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, None)]


def test_dimensions_through_a_connector(spark, connector, tmp_path):
    logs = spark.createDataFrame(
        [("d", "ip", "l", "04-25-2021", "Apple iOS", "p", 1)], STAGED_LOGS
    )
    write_parquet(logs, str(tmp_path / "logs"))
    warehouse = jobs.Warehouse("dim", "folder_warehouse", options=connector)
    jobs.build_dims(spark, str(tmp_path / "logs"), warehouse)
    found = {
        p.name: json.loads(p.read_text()) for p in tmp_path.glob("dim.*.json")
    }
    assert found == {
        "dim.dim_date.json": [[1, "2021-04-25", "25", "4", "2021", "spring"]],
        "dim.dim_devices.json": [[1, "d"]],
        "dim.dim_location.json": [[1, "l"]],
        "dim.dim_os.json": [[1, "iOS"]],
        "dim.dim_browser.json": [[1, "Apple"]],
    }
