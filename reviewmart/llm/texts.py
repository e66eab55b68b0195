"""Compressed whole texts, for joins that must move them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.tasks import ship, utf8


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        raw = data.tobytes()
        out = [zip_.compress(raw[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "z"]
        )


def zipped(docs: DataFrame) -> DataFrame:
    """(doc_id, z) of (doc_id, text): some third less to move than Spark's own codec."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_zip, "doc_id long, z binary")


def unzipped(column: pa.Array) -> tuple[list[bytes], pa.Array]:
    unzip = zstandard.ZstdDecompressor()
    texts = [unzip.decompress(x.as_buffer()) for x in column]
    return texts, pa.array(texts, pa.binary())
