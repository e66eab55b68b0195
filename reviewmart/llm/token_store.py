"""Token ids on disk: zstandard frames with a shared dictionary, one for each document.

A store is a folder of two tables, so any file system Spark writes to will do and a
lost executor's task is simply run again:

``dictionary``  one row: ``dict_hash``, ``dictionary``, ``bytes_per_id``
``blocks``      a row for some documents in order: ``part``, ``block``, ``start`` (ids
                before it in its part), ``n_ids``, ``first_doc``, ``last_doc``,
                ``doc_ids``, ``ends`` (where each document's ids end in the block),
                ``offsets`` (where its frame ends in ``frames``), ``dict_hash``, ``frames``

Documents ascend through parts, blocks and places in a block.  One document is read
by its row group statistics, one slice and one frame; see :func:`read_ids`.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmart.llm.bpe import encoder
from reviewmart.llm.tasks import chunks, ship
from reviewmart.sinks.writers import write_parquet

# The dictionary is trained on the beginnings of so many documents, picked by a hash
# of their id.  Only its fit depends on them: every document is stored whole.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 4000
DICT_BYTES = 64 << 10
LEVEL = 3
BLOCK_IDS = 1 << 18

BLOCKS = (
    "part int, block int, start long, n_ids long, first_doc long, last_doc long, "
    "doc_ids array<long>, ends array<long>, offsets array<long>, dict_hash string, frames binary"
)


def train_dictionary(docs: DataFrame, tokenizer: str, last_id: int, width: int) -> bytes:
    """A dictionary of serialized id arrays; empty if there is too little to learn from."""
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = docs.select("doc_id").orderBy(*order).limit(SAMPLE_DOCS).collect()
    rows = docs.where(F.col("doc_id").isin([r[0] for r in picked])).orderBy(*order, "text")
    rows = rows.limit(SAMPLE_DOCS).select(F.substring("text", 1, SAMPLE_CHARS)).collect()
    raw = [r[0].encode() for r in rows if r[0]]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw], dtype=np.int64)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, at = encoder(tokenizer).encode(data, offsets.astype(np.int64), last_id)
    samples = [x.astype(f"<u{width}").tobytes() for x in np.split(ids, at[1:-1])]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compression(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _pack(
    batches: Iterator[pa.RecordBatch], tokenizer: str, last_id: int, width: int, dictionary: bytes
) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    digest = hashlib.sha256(dictionary).hexdigest()
    shared = _compression(dictionary)
    if shared:
        shared.precompute_compress(LEVEL)
    zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
    schema = pa.schema(
        [
            *((x, pa.int32()) for x in ("part", "block")),
            *((x, pa.int64()) for x in ("start", "n_ids", "first_doc", "last_doc")),
            *((x, pa.list_(pa.int64())) for x in ("doc_ids", "ends", "offsets")),
            ("dict_hash", pa.string()),
            ("frames", pa.binary()),
        ]
    )
    block, start = 0, 0
    docs: list = []
    ends, offsets, frames, n_ids = [], [], [], 0

    def done() -> pa.RecordBatch:
        known = [x for x in docs if x is not None] or [None]  # nulls come first
        row = [part, block, start, n_ids, known[0], known[-1], docs, ends, offsets, digest]
        row.append(b"".join(frames))
        return pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema
        )

    for batch in batches:
        for rows, data, at in chunks(batch):
            ids, cuts = encoder(tokenizer).encode(data, at, last_id)
            raw = ids.astype(f"<u{width}")
            for i, doc in enumerate(rows.column(0).to_pylist()):
                frame = zip_.compress(raw[cuts[i] : cuts[i + 1]].tobytes())
                n_ids += int(cuts[i + 1] - cuts[i])
                docs.append(doc)
                frames.append(frame)
                ends.append(n_ids)
                offsets.append(len(frame) + (offsets[-1] if offsets else 0))
                if n_ids >= BLOCK_IDS:
                    yield done()
                    block, start = block + 1, start + n_ids
                    docs, ends, offsets, frames, n_ids = [], [], [], [], 0
    if docs:
        yield done()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, last_id: int) -> None:
    """Encode every whole text of (doc_id, text) and store its ids, then ``last_id``.

    A null text is empty: it has the last id alone.  A null ``doc_id`` comes first;
    rows with one ``doc_id`` follow each other in order of their texts.  Ids take two
    bytes each if the vocabulary allows.  An empty table makes a store of no blocks.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True)
    width = 2 if max(ids, last_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, last_id, width)
    row = [(hashlib.sha256(dictionary).hexdigest(), dictionary, width)]
    schema = "dict_hash string, dictionary binary, bytes_per_id int"
    write_parquet(spark.createDataFrame(row, schema).coalesce(1), f"{path}/dictionary")
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    pack = partial(
        _pack, tokenizer=tokenizer, last_id=last_id, width=width, dictionary=dictionary
    )
    write_parquet(ordered.mapInArrow(pack, BLOCKS), f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/dictionary").first()


def _frames(block: dict, unzip: zstandard.ZstdDecompressor, width: int) -> Iterator[tuple]:
    begin = 0
    for doc, end in zip(block["doc_ids"], block["offsets"], strict=True):
        frame = block["frames"][begin:end]
        begin = end
        yield doc, np.frombuffer(unzip.decompress(frame), f"<u{width}")


def read_ids(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of one document (of each, should several have the id); reads its blocks only."""
    kept = _dictionary(spark, path)
    unzip = zstandard.ZstdDecompressor(dict_data=_compression(bytes(kept.dictionary)))
    blocks = spark.read.parquet(f"{path}/blocks")
    found = blocks.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    out = []
    for block in found.orderBy("part", "block").collect():
        if block.dict_hash != kept.dict_hash:
            raise ValueError(f"block {block.part}/{block.block} has another dictionary")
        frames = _frames(block.asDict(), unzip, kept.bytes_per_id)
        out += [ids.tolist() for doc, ids in frames if doc == doc_id]
    return out


def _describe(
    batches: Iterator[pa.RecordBatch], dictionary: bytes, width: int, digest: str
) -> Iterator[pa.RecordBatch]:
    unzip = zstandard.ZstdDecompressor(dict_data=_compression(dictionary))
    for batch in batches:
        for block in batch.to_pylist():
            if block["dict_hash"] != digest:
                raise ValueError(f"block {block['part']}/{block['block']}: another dictionary")
            docs, sizes, sums = [], [], []
            for doc, ids in _frames(block, unzip, width):
                docs.append(doc)
                sizes.append(len(ids))
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            n = np.array(sizes, np.int64)
            starts = block["base"] + block["start"] + np.cumsum(n) - n
            columns = [pa.array(x, pa.int64()) for x in (docs, starts, n, sums)]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def describe_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: ``doc_id, start, n_tokens, ids_crc32``, read from the files.

    ``start`` counts the ids of all documents before it.  The totals of the parts, one
    row each and no more than the writer's shuffle had partitions, are broadcast.
    """
    ship(spark)
    kept = _dictionary(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    needed = blocks.select(
        "part", "block", "start", "doc_ids", "offsets", "dict_hash", "frames"
    ).join(F.broadcast(bases), "part")
    read = partial(
        _describe,
        dictionary=bytes(kept.dictionary),
        width=kept.bytes_per_id,
        digest=kept.dict_hash,
    )
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return needed.mapInArrow(read, schema)
