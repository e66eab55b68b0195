"""Versions of a table under one folder, and which of them counts.

Each write makes a folder of its own; a small file beside them, ``_current``, names the one
that counts and is renamed into place, so readers find the old version or the new one and
nothing between.  Replaced versions stay for a time: a query that began on one ends on it,
and a catalog that still points there, of another session perhaps, can be read.

::

    <place>/_current                     {"current": "v-5d2…", "replaced": {"v-01c…": 1764…}}
    <place>/v-01c…/part-….parquet        replaced at that time, goes after KEEP_HOURS
    <place>/v-5d2…/part-….parquet
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# How long a replaced version, or the rest of a write that failed, is kept.
KEEP_HOURS = 7 * 24.0
POINTER = "_current"
PREFIX = "v-"


class Folder:
    """One folder of a Hadoop file system."""

    def __init__(self, spark: SparkSession, place: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.place = place.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.place}/{name}" if name else self.place)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file; who reads it sees all of the old text or all of the new."""
        passing = self.path(f"{name}-{uuid.uuid4().hex}")
        stream = self.fs.create(passing)
        stream.write(bytearray(text.encode()))
        stream.close()
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(kind.OVERWRITE.getClass(), 1)
        options[0] = kind.OVERWRITE
        files.rename(passing, self.path(name), options)

    def versions(self) -> dict[str, float]:
        """Version folders and when each was last changed, in seconds."""
        if not self.fs.exists(self.path("")):
            return {}
        found = {x.getPath().getName(): x.getModificationTime() / 1000 for x in self.fs.listStatus(self.path("")) if x.isDirectory()}
        return {name: at for name, at in found.items() if name.startswith(PREFIX)}

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


@dataclass
class Versions:
    current: str | None = None
    replaced: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def read(folder: Folder) -> Versions:
        text = folder.read(POINTER)
        return Versions(**json.loads(text)) if text else Versions()


def place_of(location: str) -> str:
    """The folder of all versions, from a table's location: one of them, or the folder."""
    head, _, last = location.rstrip("/").rpartition("/")
    return head if last.startswith(PREFIX) else location.rstrip("/")


def current_path(spark: SparkSession, place: str) -> str | None:
    """Where the rows of the version that counts are; None before the first one."""
    name = Versions.read(Folder(spark, place)).current
    return f"{place.rstrip('/')}/{name}" if name else None


def write_version(
    spark: SparkSession, place: str, write: Callable[[str], None], keep_hours: float = KEEP_HOURS
) -> str:
    """Let ``write`` fill a fresh folder, then make it the version that counts.

    Until all rows are written, and if that fails, the old version counts.  Of several
    writers at once the last to end wins, and the others' versions are kept as replaced.
    Returns the folder.
    """
    folder = Folder(spark, place)
    name = f"{PREFIX}{uuid.uuid4().hex}"
    try:
        write(f"{folder.place}/{name}")
    except BaseException:
        folder.delete(name)
        raise
    # Read only now: another session may have written meanwhile.
    known, now = Versions.read(folder), time.time()
    replaced = dict(known.replaced)
    if known.current:
        replaced[known.current] = now
    oldest = now - keep_hours * 3600
    there = folder.versions()
    gone = [x for x, at in there.items() if x != name and replaced.get(x, at) <= oldest]
    replaced = {x: at for x, at in replaced.items() if x in there and x not in gone}
    folder.put(POINTER, json.dumps({"current": name, "replaced": replaced}))
    for x in gone:
        folder.delete(x)
    return f"{folder.place}/{name}"
