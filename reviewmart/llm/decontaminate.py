"""Benchmark decontamination: MinHash containment search, then exact containment.

Only DataFrame functions.  A short test item is held by a long document if enough of
the item's word shingles occur in it, however much else the document says, so the
sketch is the item's: its k shingles of least hash (a bottom-k MinHash sketch).  Items
are partitioned by size, and k grows with the partition so that no item can be missed:
a document that holds a share t of n shingles lacks at most n - ceil(t n) of them, and
so has at least one of any n - ceil(t n) + 1.  Documents that have a sketched shingle
are candidates; their whole shingle sets are then compared as texts.
"""

from __future__ import annotations

import uuid
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmart.llm.tasks import stage


# Sketched shingles that go to the tasks as a constant, 8 bytes each; with more, the
# documents' shingles are joined to them.
MAX_CONSTANT = 20_000
# Shingles of test items that may be broadcast; with more, they are joined by shuffle.
MAX_BROADCAST = 200_000
BLANKS = "\t\n\x0b\f\r"


def words(text: str) -> Column:
    """Lower-cased (A-Z) words between ASCII white space; none for null."""
    plain = F.translate(
        F.coalesce(F.col(text).cast("string"), F.lit("")),
        ascii_uppercase + BLANKS,
        ascii_lowercase + " " * len(BLANKS),
    )
    return F.array_remove(F.split(plain, " "), "")


def shingles(text: str, size: int, make) -> Column:
    """``make(first, ...)`` of every ``size`` consecutive words; of all, with fewer words.

    The words are bound to a lambda variable: the optimizer, which pushes filters on
    shingles below them, would else split the text anew for each shingle.
    """

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - size)
        every = F.transform(starts, lambda i: make(*(F.get(w, i + j) for j in range(size))))
        whole = F.array(make(F.concat_ws(" ", w)))
        return (
            F.when(F.size(w) >= size, every)
            .when(F.size(w) > 0, whole)
            .otherwise(F.slice(whole, 1, 0))
        )

    return F.get(F.transform(F.array(words(text)), of), 0)


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _text(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def item_sketches(items: DataFrame, threshold: float, size: int) -> DataFrame:
    """(item_id, n_shingles, size_class, hash): the k least hashes of every item.

    A size class holds the items of 2^c to 2^(c+1) - 1 shingles, and k suits its largest.
    """
    hashed = (
        items.select("item_id", F.explode(shingles("text", size, _hash)).alias("h"))
        .groupBy("item_id")
        .agg(F.collect_set("h").alias("h"))
    )
    n = F.size("h")
    sized = hashed.where(n > 0).withColumn("size_class", F.floor(F.log2(n)))
    largest = Window.partitionBy("size_class")
    sized = sized.withColumn("largest", F.max(F.size("h")).over(largest))
    lacking = F.col("largest") - F.ceil(F.col("largest") * threshold)
    return sized.select(
        "item_id",
        F.size("h").alias("n_shingles"),
        "size_class",
        F.explode(F.slice(F.array_sort("h"), 1, (lacking + 1).cast("int"))).alias("hash"),
    )


def _held(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.75,
    size: int = 5,
    folder: str | None = None,
    fixed: bool = False,
) -> DataFrame:
    """``row, doc_id, item_id, n_shingles, n_common`` for (row, doc_id, text), row by row.

    ``row`` is a number of the row's own; ``fixed`` if it is the same on each reading.
    """
    items = items.select("item_id", F.col("text").cast("string"))
    # One text per item: repeated items have the shingles of all their rows.
    item_shingles = (
        items.select("item_id", F.explode(shingles("text", size, _text)).alias("shingle"))
        .distinct()
    )
    item_shingles = stage(item_shingles, "item-shingles", folder)
    sketches = stage(item_sketches(items, threshold, size), "item-sketches", folder)
    keys = sketches.select("hash").distinct()
    n_keys = keys.count()

    if n_keys <= MAX_CONSTANT:
        # Folded to one constant of the plan.
        listed = F.lit(",".join(str(r[0]) for r in keys.collect()))
        constant = F.array_compact(F.split(listed, ",").try_cast("array<long>"))
        hashed = docs.withColumn("h", shingles("text", size, _hash))
        candidates = hashed.where(F.arrays_overlap("h", constant))
    else:
        docs = docs if fixed else stage(docs, "numbered", folder)
        found = docs.select("row", F.explode(shingles("text", size, _hash)).alias("hash"))
        found = found.join(keys, "hash", "semi").select("row").distinct()
        candidates = docs.join(found, "row", "semi")
    candidates = candidates.select("row", "doc_id", "text")
    candidates = stage(candidates, "candidates", folder)

    few = item_shingles.count() <= MAX_BROADCAST
    table = F.broadcast(item_shingles) if few else item_shingles
    sizes = item_shingles.groupBy(F.col("item_id").alias("sized_id")).agg(
        F.count("*").alias("n_shingles")
    )
    common = (
        candidates.withColumn("s", F.array_distinct(shingles("text", size, _text)))
        .select("row", "doc_id", F.explode("s").alias("shingle"))
        .join(table, "shingle")
        .groupBy("row", "doc_id", "item_id")
        .agg(F.count("*").alias("n_common"))
    )
    enough = F.col("n_common") >= F.ceil(F.col("n_shingles") * threshold)
    same = F.col("item_id").eqNullSafe(F.col("sized_id"))
    return common.join(sizes, same).where(enough).drop("sized_id")


def contained(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.75,
    size: int = 5,
    folder: str | None = None,
) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_common``: items held by documents.

    Both tables have a ``text``; other columns are ignored.  Words are lower-cased; an
    item's ``n_shingles`` distinct shingles of ``size`` words occur in the document to a
    share of ``threshold`` at least.  A text of fewer words is one shingle, and so found
    only in an equal short text.  Null and empty texts hold nothing and are in nothing.
    Rows that share a ``doc_id`` are judged one by one, and the best is told; so are
    rows that share an ``item_id``, whose shingles count together.  Null is an id like
    any other on both sides: such documents are told under a null ``doc_id``, and such
    items, together, under a null ``item_id``.
    """
    docs = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string")
    )
    held = _held(docs, items, threshold, size, folder)
    best = held.groupBy("doc_id", "item_id", "n_shingles").agg(F.max("n_common").alias("n_common"))
    return best.select("doc_id", "item_id", "n_shingles", "n_common")


def without_contaminated(
    docs: DataFrame, items: DataFrame, folder: str | None = None, **options
) -> DataFrame:
    """The rows that hold no item, all columns, each judged by itself, whatever its id."""
    again = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    number = f"row_{uuid.uuid4().hex[:8]}"
    if again.isEmpty():
        numbered = docs.withColumn(number, F.col("doc_id"))
    else:
        numbered = docs.withColumn(number, F.monotonically_increasing_id())
        numbered = stage(numbered, "numbered-rows", folder)
    texts = numbered.select(F.col(number).alias("row"), "doc_id", F.col("text").cast("string"))
    held = _held(texts, items, folder=folder, fixed=True, **options)
    gone = stage(held.select(F.col("row").alias(number)).distinct(), "contaminated", folder)
    return numbered.join(gone, number, "anti").select(*docs.columns)
