"""URL filter over a sorted digest array.

A list of blocked entries is built into one file: the sorted 64-bit xxhash digests of
the entries, where each entry's text begins, and the texts.  Tasks map the file into
memory, so executors share one copy in the page cache and only probed pages are read.
Probes of a whole batch are found by vectorised binary search, and the stored text
confirms each hit: a digest that two strings share never blocks the wrong one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.tasks import ship

# The driver sorts the entries and each executor has one copy of the file on its disk;
# larger lists are refused.
MAX_LIST_BYTES = 256 << 20


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def write_digests(entries: Sequence[bytes], path: str) -> None:
    """The file: number of entries, length of the longest, digests, text offsets, texts."""
    entries = sorted(set(entries), key=lambda x: (xxhash.xxh64_intdigest(x), x))
    digests = np.array([xxhash.xxh64_intdigest(x) for x in entries], "<u8")
    sizes = np.array([0, *map(len, entries)], "<u8")
    with open(path, "wb") as out:
        out.write(np.array([len(entries), sizes.max()], "<u8").tobytes())
        out.write(digests.tobytes())
        out.write(np.cumsum(sizes, dtype="<u8").tobytes())
        out.write(b"".join(entries))


class DigestArray:
    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        n, self.longest = (int(x) for x in data[:16].view("<u8"))
        self.digests = data[16 : 16 + 8 * n].view("<u8")
        self.offsets = data[16 + 8 * n : 24 + 16 * n].view("<u8")
        self.texts = data[24 + 16 * n :]

    def contains(self, probes: Sequence[bytes]) -> np.ndarray:
        digests = np.array([xxhash.xxh64_intdigest(x) for x in probes], "<u8")
        low = np.searchsorted(self.digests, digests, "left")
        high = np.searchsorted(self.digests, digests, "right")
        found = np.zeros(len(probes), bool)
        for i in np.flatnonzero(high > low):
            for at in range(low[i], high[i]):
                begin, end = self.offsets[at : at + 2]
                found[i] |= self.texts[begin:end].tobytes() == probes[i]
        return found


_arrays: dict[str, DigestArray] = {}


def _array(name: str) -> DigestArray:
    if name not in _arrays:
        _arrays.clear()
        _arrays[name] = DigestArray(SparkFiles.get(name))
    return _arrays[name]


def _probes(host: str, path: str, longest: int) -> list[bytes]:
    """What may be listed: the host and those above it, and the host with its path.

    What is longer than the longest entry is not in the list, so it is not made: a host
    of many labels takes no more than that many probes.
    """
    raw, out = host.encode(), []
    at = len(raw)
    while at > 0 and (at := raw.rfind(b".", 0, at)) >= 0 and len(raw) - at - 1 <= longest:
        out.append(raw[at + 1 :])
    return [*out, *(x for x in (raw, raw + path.encode()) if len(x) <= longest)]


def _blocked(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    held = _array(name)
    for batch in batches:
        hosts, paths = (batch.column(batch.schema.names.index(x)) for x in ("host", "path"))
        probes, row = [], []
        for i, (host, path) in enumerate(zip(hosts.to_pylist(), paths.to_pylist(), strict=True)):
            own = _probes(host, path, held.longest) if host else []
            probes += own
            row += [i] * len(own)
        hit = np.zeros(batch.num_rows, bool)
        hit[np.array(row, np.int64)[held.contains(probes)]] = True
        yield batch.append_column("listed", pa.array(hit))


def ship_list(spark: SparkSession, blocked: DataFrame) -> str:
    """Build the file from (entry string) and give it to all executors; its name there.

    Entries are hosts, which also block their subdomains, or host and path.  Their size
    is measured before any of them is fetched.
    """
    blocked = blocked.where(F.length("entry") > 0).select("entry").distinct()
    size = blocked.agg(F.sum(F.octet_length("entry") + 16)).first()[0] or 0
    if size > MAX_LIST_BYTES:
        raise ValueError(f"the list takes {size} bytes; at most {MAX_LIST_BYTES} are shipped")
    name = f"digests-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(prefix="reviewmart-"), name)
    write_digests([r[0].encode() for r in blocked.toLocalIterator()], path)
    spark.sparkContext.addFile(path)
    return name


def split_url(url: str = "url") -> list:
    """``host`` and ``path`` columns.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    path: from there up to ``?``, ``#`` or the end.  Both empty without ``://``.
    """
    parts = r"://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, parts, 1), ascii_uppercase, ascii_lowercase)
    return [host.alias("host"), F.regexp_extract(text, parts, 2).alias("path")]


def judge(pages: DataFrame, rules: Sequence[Rule], list_name: str) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of (page_id, url).

    The longest rule that fits wins, the first given among equals; without one, a page
    is blocked if its host, a host above it, or its host and path are in the list.  Rows
    with a null or odd url have an empty host, fit no rule and are allowed.  Repeated
    rows are judged alike; other columns are ignored; an empty table gives none.

    One pass without a shuffle, reading ``page_id`` and ``url`` only.
    """
    ship(pages.sparkSession)
    split = pages.select("page_id", *split_url())
    best, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    host, path = F.col("host"), F.col("path")
    # Each one is put before those so far, so the longest is looked at first.
    for rule in sorted(rules[::-1], key=lambda r: len(r.name)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        fits = fits & path.startswith(rule.path)
        best = F.when(fits, rule.name).otherwise(best)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    schema = "page_id long, host string, path string, rule string, ruled string, listed boolean"
    ruled = split.select(
        F.col("page_id").cast("long"), host, path, best.alias("rule"), verdict.alias("ruled")
    )
    probed = ruled.mapInArrow(partial(_blocked, name=list_name), schema)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return probed.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict")
    )
