"""Near-duplicate join: all document pairs with Jaccard similarity over word shingles.

Exact, by prefixes of token combinations.  A document's shingles are put in one order
for all: rare ones first, frequent ones last, by hash within a class.  Two sets that
overlap in t shingles share their least common one within the first n - t + 1 of either
(the prefix), and the next common one within the prefix extended by one.  So a document
is indexed under

- each rare shingle of its prefix, and
- if it is small, each combination of two frequent ones, the first in the prefix, the second
  in the extended one: if the least common shingle is frequent, so is the next one;
- if not, each frequent one of its prefix, as combinations grow with the square of a set's
  size; sizes from which on a similar set may be on the other side have both;

and every similar pair meets under a key.  What meets is verified on whole sets.

Two exact bounds keep what meets few.  At its first common shingle a pair shares no more
than what stands from there on in either set, so a row of the index has its place and its
set's size, and goes where no other set under its key leaves enough: similar pairs pass at
their first key, and most that share a shingle by chance never enter the index, however many
documents there are to share it with.  Only one row of equal sets enters.  And of every set
512 parities are kept, of the shingles that hash to each: where they differ, the sets do,
so sets whose parities differ in more places than similar ones may are not similar.  What is
left is tested by more parities, one to two for each shingle, before texts are fetched.

Components are asked for, not pairs, so big groups are never expanded: equal sets are
one class, and classes with an equal MinHash value are first verified against that
value's smallest document only.  Under a key, pairs of different components alone are
left to verify.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial, reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.components import components
from reviewmart.llm.routing import flags, repeated
from reviewmart.llm.tasks import (
    LOWER,
    chunks,
    give_back,
    mixed,
    rolled,
    ship,
    span_hashes,
    stage,
    utf8,
    word_bounds,
)
from reviewmart.llm.texts import unzipped, zipped
from reviewmart.scratch import delete_folder, scratch_path

SIZE = 5
PERCENT = 75
# Shingles of so many documents are indexed in combinations, by sets of up to COMBINED.  Which ones are frequent
# changes the work, not the result, so counts below LOCAL in a million shingles of a
# task are not summed, and of the frequent ones the first MAX_FREQUENT count as such.
FREQUENT, LOCAL, COUNTED, MAX_FREQUENT = 1000, 4, 1 << 20, 1 << 16
COMBINED = 64
MINHASHES = 4
# Words of 64 parities.
PARITIES = 8
# Sets under a key whose pairs are tested before they enter the index; more enter untested.
MEETING = 32
# Pairs, and bytes of compressed texts, that are unpacked together.
PAIRS, PAIR_BYTES = 64, 1 << 20
ONE = np.uint64(1)

HASHES = [f"m{j}" for j in range(MINHASHES)]
BITS = [f"p{j}" for j in range(PARITIES)]
SETS = "kind byte, id long, n long, s1 long, s2 long, " + ", ".join(
    f"{x} long" for x in [*HASHES, *BITS]
) + ", sketch binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SIZE):
    """Sorted distinct shingle hashes of every text, end to end, and each text's bounds."""
    data = LOWER[data]
    starts, ends, at = word_bounds(data, offsets)
    words = span_hashes(data, starts, ends)
    n = np.diff(at)
    doc_of_word = np.repeat(np.arange(len(n)), n)
    every = rolled(words, size)
    first = doc_of_word[: len(every)]
    inside = first == doc_of_word[size - 1 :] if len(every) else np.zeros(0, bool)
    hashes, docs = every[inside], first[inside]
    for i in np.flatnonzero((n > 0) & (n < size)):
        whole = words[at[i] : at[i + 1]].copy()
        total = np.full(1, len(whole), np.uint64)
        for word in whole:
            total = mixed(total ^ word)
        hashes, docs = np.append(hashes, total), np.append(docs, i)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[new], docs[new]
    return hashes, np.searchsorted(docs, np.arange(len(n) + 1))


def _per_text(ufunc, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Reduced values of each text; 0 for those without any."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.zeros(len(bounds) - 1, np.uint64)
    if len(some):
        out[some] = ufunc.reduceat(values, bounds[some])
    return out


def _seed(j: int) -> np.uint64:
    return mixed(np.array([j + 1], np.uint64))[0]


def _names(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """128 bits that name each set."""
    return [_per_text(np.add, mixed(hashes ^ _seed(j)), bounds) for j in (11, 13)]


def _parities(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Bit i of a set: whether an odd number of its shingles hash to i."""
    place = mixed(hashes ^ _seed(17)) >> np.uint64(55)
    word, bit = place >> np.uint64(6), ONE << (place & np.uint64(63))
    zero = np.uint64(0)
    return [
        _per_text(np.bitwise_xor, np.where(word == j, bit, zero), bounds) for j in range(PARITIES)
    ]


def _sketches(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Parities of each set, their number the power of two from its size."""
    place = mixed(hashes ^ _seed(19)).view(np.int64)
    out = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        bits = max(64, 1 << int(high - low - 1).bit_length()) if high > low else 64
        odd = np.bincount(place[low:high] & (bits - 1), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return out


def _differing(x: bytes, y: bytes) -> int:
    """In how many parities two sketches differ; the longer one is folded to the other's size."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        half = len(a) // 2
        a = a[:half] ^ a[half:]
    return int.from_bytes((a ^ b).tobytes(), "little").bit_count()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SETS.split(", ")]

    def rows(kind: int, id_, n, *others, sketches=None) -> pa.RecordBatch:
        others = [np.asarray(x, np.uint64).view(np.int64) for x in others]
        others += [np.zeros(len(n), np.int64)] * (len(names) - 4 - len(others))
        columns = [pa.array(np.full(len(n), kind, np.int8)), id_, pa.array(np.asarray(n, np.int64))]
        columns += [*map(pa.array, others), pa.array(sketches or [None] * len(n), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def frequent() -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(seen), return_counts=True)
        token, n = token[n >= LOCAL], n[n >= LOCAL]
        return rows(1, pa.array(token.view(np.int64)), n)

    seen, held = [], 0
    for batch in batches:
        for part, data, offsets in chunks(batch):
            hashes, bounds = shingle_sets(data, offsets)
            mins = [_per_text(np.minimum, mixed(hashes ^ _seed(j)), bounds) for j in range(MINHASHES)]
            values = [*_names(hashes, bounds), *mins, *_parities(hashes, bounds)]
            sketches = _sketches(hashes, bounds)
            yield rows(0, part.column(0), np.diff(bounds), *values, sketches=sketches)
            seen.append(hashes)
            held += len(hashes)
            if held >= COUNTED:
                yield frequent()
                seen, held = [], 0
    if seen:
        yield frequent()
        seen = []
    give_back()


def least_overlap(n: np.ndarray) -> np.ndarray:
    """A set of n shingles shares so many, at least, with any that is similar."""
    return -(-n * PERCENT // 100)


def index_keys(hashes: np.ndarray, bounds: np.ndarray, frequent: np.ndarray):
    """Keys to index sets under, each key's set, and its place there.

    The place of a single shingle is how many stand before it, that of a combination how
    many stand before its second one, less one: from there on, the set has as many common
    shingles at most as it has places.  The lowest bit tells a combination from a single.
    """
    n = np.diff(bounds)
    doc = np.repeat(np.arange(len(n)), n)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        often = frequent[at] == hashes
    else:
        often = np.zeros(len(hashes), bool)
    order = np.lexsort((hashes, often, doc))  # rare first in each set
    hashes, often = hashes[order], often[order]
    rank = np.arange(len(hashes)) - bounds[doc]
    prefix = (n - least_overlap(n) + 1)[doc]
    # A set that is similar to one of more than COMBINED has more than so many itself.
    large, small = n * 100 > COMBINED * PERCENT, n <= COMBINED
    single = (rank < prefix) & (~often | large[doc])
    keys, docs, places = [hashes[single] & ~ONE], [doc[single]], [rank[single]]
    left = np.flatnonzero((rank < prefix) & often & small[doc])
    for i in np.unique(doc[left]):
        own = left[np.searchsorted(doc[left], i) : np.searchsorted(doc[left], i, "right")]
        extended = hashes[own[0] : min(own[-1] + 2, bounds[i + 1])]
        if len(extended) == 1:
            # A set of one shingle: only an equal one is similar, and that is its class.
            continue
        a, b = np.triu_indices(len(extended), 1)
        keys.append(mixed(mixed(extended[a]) ^ extended[b]) | ONE)
        docs.append(np.full(len(a), i))
        places.append(rank[own[0]] + b - 1)
    return tuple(map(np.concatenate, (keys, docs, places)))


def _index(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    met: set[bytes] = set()  # sets of this task, as 16-byte sums
    for batch in batches:
        for part, data, offsets in chunks(batch):
            hashes, bounds = shingle_sets(data, offsets)
            names = np.stack(_names(hashes, bounds), 1)
            new = np.zeros(len(names), bool)
            for i, name in enumerate(names):
                if (name := name.tobytes()) not in met and bounds[i + 1] > bounds[i]:
                    met.add(name)
                    new[i] = True
            keys, docs, places = index_keys(hashes, bounds, frequent)
            keys, docs, places = (x[new[docs]] for x in (keys, docs, places))
            sets, n = names[docs, 0].view(np.int64), np.diff(bounds)[docs].astype(np.int32)
            for low in range(0, len(keys), 1 << 16):
                own = slice(low, low + (1 << 16))
                if low == 0:
                    flag = flags(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[own].view(np.int64)),
                        pa.array(flag[own]),
                        pa.array(sets[own]),
                        pa.array(places[own].astype(np.int32)),
                        pa.array(n[own]),
                    ],
                    names=["key", "flag", "s1", "place", "n"],
                )
    give_back()


def _may_meet(batch: pa.RecordBatch, group: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of the rows that may be a similar pair's first meeting, one of each set."""
    s1, place, n = (batch.column(x).to_numpy().astype(np.int64) for x in ("s1", "place", "n"))
    at = np.lexsort((place, s1, group))
    new = np.ones(len(at), bool)
    new[1:] = (group[at[1:]] != group[at[:-1]]) | (s1[at[1:]] != s1[at[:-1]])
    at = at[new]
    group, place, n = group[at], place[at], n[at]
    group = group - group[0]
    keep = known[at] | (np.bincount(group)[group] > MEETING)
    for step in range(1, MEETING):
        a = np.flatnonzero(group[step:] == group[:-step])
        if not len(a):
            break
        b = a + step
        total = (n[a] + n[b]) * PERCENT
        may = (n[a] * 100 >= n[b] * PERCENT) & (n[b] * 100 >= n[a] * PERCENT)
        for x in (a, b):
            may &= (n[x] - place[x]) * (100 + PERCENT) >= total
        keep[a[may]] = keep[b[may]] = True
    return at[keep]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of few pairs and few bytes; a longer pair is a part of its own."""
    size = sum(pc.binary_length(batch.column(i)).to_numpy().astype(np.int64) for i in (2, 3))
    low, held = 0, 0
    for i, x in enumerate(size):
        if i > low and (held + x > PAIR_BYTES or i - low == PAIRS):
            yield batch.slice(low, i - low)
            low, held = i, 0
        held += x
    if low < batch.num_rows:
        yield batch.slice(low)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in _slices(whole)):
        sides = []
        for i in (2, 3):
            data, offsets = utf8(unzipped(batch.column(i))[1])
            sides.append(shingle_sets(data, offsets))
        (h, at), (k, to) = sides
        keep = []
        for i in range(batch.num_rows):
            x, y = h[at[i] : at[i + 1]], k[to[i] : to[i + 1]]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both) and both > 0)
        kept = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals = batch.column(2).to_numpy()
        keep = [
            not (x.is_valid and y.is_valid)
            or _differing(x.as_py(), y.as_py()) * (100 + PERCENT) <= total * (100 - PERCENT)
            for total, x, y in zip(totals, batch.column(3), batch.column(4), strict=True)
        ]
        kept = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])


def _near(pairs: DataFrame, sized: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sketches do not rule out."""

    def side(name: str) -> DataFrame:
        return sized.selectExpr(f"rep {name}", f"n_low n{name}", f"sketch x{name}")

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    met = met.select("a", "b", F.expr("na + nb"), "xa", "xb")
    return met.mapInArrow(_tested, "a long, b long")


def _may_link() -> Column:
    """Whether rows a and b of one key may be a similar pair that meets there first.

    Both sides have ``n_low, n_high`` (set sizes; several if the document has several
    texts), ``place`` and the parities, null where several sets are one document.
    """
    total = F.expr("a.n_low + b.n_low")
    tests = [F.expr(f"{x}.n_high * 100 >= {y}.n_low * {PERCENT}") for x, y in ("ab", "ba")]
    tests += [F.expr(f"({x}.n_high - {x}.place) * {100 + PERCENT}") >= total * PERCENT for x in "ab"]
    differ = reduce(add, (F.bit_count(F.col(f"a.{p}").bitwiseXOR(F.col(f"b.{p}"))) for p in BITS))
    near = differ * (100 + PERCENT) <= total * (100 - PERCENT)
    return reduce(and_, tests) & F.coalesce(near, F.lit(True))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar."""
    a = texts.select(F.col("doc_id").alias("a"), F.col("z").alias("za"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("z").alias("zb"))
    met = pairs.join(a, "a").join(b, "b").select("a", "b", "za", "zb")
    return met.mapInArrow(_similar, "a long, b long")


def near_duplicates(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of (doc_id, text).

    Words are lower-cased (A-Z); a set is a text's distinct shingles of five words, or
    its whole word sequence if shorter.  Documents link at a similarity of 0.75, and
    ``component_id`` is the smallest ``doc_id`` that links reach.  Null, empty and blank
    texts have no set and link with nothing.  Rows that share a ``doc_id`` are one
    document with several texts, linked by what any of them links with; a null
    ``doc_id`` links with nothing and has a null component.  Other columns are ignored;
    an empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = f"{folder}/jaccard-{uuid.uuid4().hex}" if folder else scratch_path(spark, "jaccard")

    def forget(label: str) -> None:
        """Nothing reads this table any more."""
        delete_folder(spark, f"{folder}/{label}")

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    both = stage(docs.mapInArrow(_sets, SETS), "sets", folder)
    sets = both.where("kind = 0").drop("kind").withColumnRenamed("id", "doc_id")
    counts = both.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "id").limit(MAX_FREQUENT)
    frequent = np.sort(np.array([r["id"] for r in often.collect()], np.int64).view(np.uint64))

    some = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("s1", "s2").agg(
        F.min("doc_id").alias("rep"), *(F.first(x).alias(x) for x in ["n", *HASHES, *BITS, "sketch"])
    )
    classes = stage(classes, "classes", folder)
    of_doc = some.join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).select("doc_id", "rep", "n")
    of_doc = stage(of_doc, "doc-classes", folder)

    # Rows without an id go first: they must not stand in for equal sets of others.
    keyed = docs.where("doc_id IS NOT NULL").mapInArrow(
        partial(_index, frequent=frequent), "key long, flag byte, s1 long, place int, n int"
    )
    index = stage(repeated(keyed, _may_meet).drop("n"), "index", folder)

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        """The similar pairs; only texts of documents in pairs are moved to them."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        texts = stage(zipped(docs).join(ids, "doc_id", "semi"), f"{label}-texts", folder)
        links = stage(_verified(pairs, texts), label, folder)
        forget(f"{label}-texts")
        return links

    alone = F.count("*") == 1  # else several sets are one document
    sized = classes.groupBy("rep").agg(
        F.min("n").alias("n_low"),
        F.max("n").alias("n_high"),
        *(F.when(alone, F.max(p)).alias(p) for p in [*BITS, "sketch"]),
    )

    values = F.explode(F.array(*(F.struct(F.lit(j).alias("j"), F.col(f"m{j}").alias("m")) for j in range(MINHASHES))))
    hashed = classes.select("rep", values.alias("v")).select("rep", "v.*")
    heads = hashed.groupBy("j", "m").agg(F.min("rep").alias("a"), F.count("*").alias("c"))
    stars = hashed.join(heads.where("c > 1"), ["j", "m"]).where("a <> rep")
    stars = stars.select("a", F.col("rep").alias("b")).distinct()
    stars = stage(_near(stars, sized), "stars", folder)
    links = verified(stars, "star-links")
    same = of_doc.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    # A document with several texts ties their classes together.
    ties = stage(links.union(same), "ties", folder)
    known = components(ties, f"{folder}/known")

    labelled = classes.select("s1", "rep").join(known.withColumnRenamed("id", "rep"), "rep", "left")
    labelled = labelled.select("s1", "rep", F.coalesce("component", "rep").alias("c"))
    labelled = stage(index.join(labelled, "s1").drop("s1"), "labelled", folder)
    forget("index")
    # Dealt by key once, for the keys' components and for the join with them.
    labelled = labelled.repartition("key")
    mixed_keys = labelled.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"))
    mixed_keys = mixed_keys.where("x < y").select("key")
    # A set that one task holds with its key and others without may have come twice.
    open_ = labelled.join(mixed_keys, "key").groupBy("key", "rep")
    open_ = open_.agg(F.min("place").alias("place"), F.first("c").alias("c"))
    open_ = stage(open_.join(sized.drop("sketch"), "rep"), "open", folder)
    forget("labelled")
    a, b = open_.alias("a"), open_.alias("b")
    same_key = (F.col("a.key") == F.col("b.key")) & F.expr("a.c < b.c")
    met = a.join(b, same_key & _may_link())
    pairs = met.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()
    pairs = stage(_near(pairs, sized), "near-pairs", folder)
    forget("open")
    more = verified(pairs, "links-rest")
    for label in ("near-pairs", "classes", "doc-classes"):
        forget(label)
    final = components(ties.union(more), f"{folder}/final")
    joined = sets.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The documents, all columns, without those linked to one of smaller ``doc_id``.

    Of rows that share a ``doc_id`` one stays; rows without one all stay.
    """
    found = stage(near_duplicates(docs, folder), "near-duplicates", folder)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "anti").select(*docs.columns)
    again = found.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL")
    if again.isEmpty():
        return kept
    named = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return named.union(kept.where("doc_id IS NULL"))


def one_of_each_row(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows, all columns, without those linked to a row before in order of ``doc_id``.

    Each row is a document of its own, whether its ``doc_id`` is null, repeated or not:
    only texts that are near copies go.  Rows without an id come last, so that of equal
    texts one with an id stays.
    """
    id_ = F.col("doc_id").cast("long")
    again = docs.groupBy(id_.alias("doc_id")).count().where("count > 1 OR doc_id IS NULL")
    if again.isEmpty():
        return one_of_each(docs, folder)
    # Rows of one id go by their texts' hash, so that many of them are many tasks' work.
    order = [id_.asc_nulls_last(), F.xxhash64("text")]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    number = f"row_{uuid.uuid4().hex[:8]}"
    ordered = ordered.withColumn(number, F.monotonically_increasing_id())
    numbered = stage(ordered, "numbered", folder)
    found = near_duplicates(numbered.select(F.col(number).alias("doc_id"), "text"), folder)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(number))
    gone = stage(gone, "near-duplicates", folder)
    return numbered.join(gone, number, "anti").select(*docs.columns)
