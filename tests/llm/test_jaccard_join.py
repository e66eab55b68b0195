"""Near-duplicate join against all pairs."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from cases import documents, frame, split

from reviewmart.llm import jaccard_join, tasks


def shingles(text):
    w = [bytes(x).lower() if x.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in split(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def due(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                a_, b_ = find(a), find(b)
                up[max(a_, b_)] = min(a_, b_)
    return sorted(((d, len(x), None if d is None else find(d)) for d, x in sets), key=str)


ODD = [(5, "one two three"), (5, "p q r s t u v w"), (6, "p q r s t u v w"), (None, "one two three"), (None, None)]


def chain():
    """Each near the next one only, and copies of the middle."""
    word = [f"w{i}" for i in range(100)]
    out = []
    for i in range(8):
        for j in range(3 * i, 3 * i + 3):
            word[j * 4 % 100] = f"v{j}"
        out.append(" ".join(word))
    return [(100 + i, t) for i, t in enumerate([*out, out[4], out[4]])]


@pytest.mark.parametrize("frequent", [1000, 2])
@pytest.mark.parametrize("extra", [[], ODD])
def test_against_all_pairs(spark, monkeypatch, frequent, extra):
    # With every shingle of two documents frequent, all keys are combinations.
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rows = documents() + chain() + extra
    found = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == due(rows)


@pytest.mark.parametrize("rows_at_once", ["1000", "2"])
def test_rows_without_an_id_take_no_links_away(spark, monkeypatch, rows_at_once):
    # All in one task; a null id comes before an equal text, or shares its batch with a near copy.
    monkeypatch.setattr(tasks, "BATCH_ROWS", rows_at_once)
    rows = []
    for i in range(8):
        word = [f"w{i}x{j}" for j in range(100)]
        other = [*word[:50], "new", *word[51:]]
        far = [*word[:90], "end", *word[91:]]
        rows += [(None, " ".join(word)), (10 * i, " ".join(word if i % 2 else far)), (10 * i + 1, " ".join(other))]
        rows.append((10 * i + 2, f"alone{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = jaccard_join.near_duplicates(docs).collect()
    assert sorted(map(tuple, found), key=str) == due(rows)


def test_combinations_of_frequent_shingles_find_all_pairs():
    rng = np.random.default_rng(0)
    for trial in range(300):
        n = int(rng.integers(2, 30))
        x = np.sort(rng.choice(1000, n, replace=False)).astype(np.uint64)
        change = int(rng.integers(0, n // 4 + 2))
        y = np.sort(np.unique(np.append(x[change // 2 :], rng.integers(1000, 2000, change - change // 2).astype(np.uint64))))
        both = len(np.intersect1d(x, y))
        frequent = np.sort(rng.choice(2000, trial * 7 % 2000, replace=False)).astype(np.uint64)
        x, y, frequent = (2 * v for v in (x, y, frequent))  # keys leave the lowest bit out
        bounds = np.array([0, len(x), len(x) + len(y)])
        hashes = np.concatenate([x, y])
        keys, docs, places = jaccard_join.index_keys(hashes, bounds, frequent)
        if 100 * both >= 75 * (len(x) + len(y) - both) and len(x) > 1:
            sides = [dict(zip(keys[docs == i].tolist(), (n - places[docs == i]).tolist(), strict=True)) for i, n in enumerate((len(x), len(y)))]
            shared = sides[0].keys() & sides[1].keys()
            # At one of them both sets have enough places left for what they share.
            assert any(min(s[k] for s in sides) * 175 >= 75 * (len(x) + len(y)) for k in shared)
            assert all(s[k] >= 1 for s in sides for k in shared)
        parities = jaccard_join._parities(hashes, bounds)
        differ = sum(int(p[0] ^ p[1]).bit_count() for p in parities)
        assert differ <= len(x) + len(y) - 2 * both
        differ = jaccard_join._differing(*jaccard_join._sketches(hashes, bounds))
        assert differ <= len(x) + len(y) - 2 * both and differ % 2 == (len(x) + len(y)) % 2


def test_index_of_sets_of_frequent_shingles_grows_with_their_size():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(30, 120))
        x = 2 * np.sort(rng.choice(1000, n, replace=False)).astype(np.uint64)
        gone = rng.choice(n, int(rng.integers(0, n // 4 + 1)), replace=False)
        y = np.delete(x, gone)
        own = 2 * rng.choice(np.arange(1000, 2000), int(rng.integers(0, n // 8)), replace=False).astype(np.uint64)
        y = np.sort(np.append(y, own))
        both = n - len(gone)
        frequent = 2 * np.arange(2000 if rng.random() < 0.5 else 900).astype(np.uint64)
        hashes, bounds = np.concatenate([x, y]), np.array([0, n, n + len(y)])
        keys, docs, places = jaccard_join.index_keys(hashes, bounds, frequent)
        assert len(keys) <= 400
        if 100 * both >= 75 * (n + len(y) - both):
            sides = [dict(zip(keys[docs == i].tolist(), (m - places[docs == i]).tolist(), strict=True)) for i, m in enumerate((n, len(y)))]
            shared = sides[0].keys() & sides[1].keys()
            assert any(min(s[k] for s in sides) * 175 >= 75 * (n + len(y)) for k in shared)
    large = 2 * np.arange(4000).astype(np.uint64)
    assert len(jaccard_join.index_keys(large, np.array([0, 4000]), large)[0]) == 1001


def test_near_copies_of_large_frequent_texts(spark, monkeypatch):
    """All shingles are frequent, sizes lie on both sides of those with combinations."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    rng = np.random.default_rng(6)
    rows = []
    for i in range(120):
        word = [f"w{j}" for j in range(int(rng.integers(45, 95)))]
        for j in rng.choice(len(word), int(rng.integers(0, 3)), replace=False):
            word[j] = f"other{j}"
        rows.append((i, " ".join(word)))
    found = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == due(rows)


def test_texts_are_compared_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIR_BYTES", 300)
    monkeypatch.setattr(jaccard_join, "PAIRS", 3)
    rows = documents() + chain()
    found = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == due(rows)


def test_many_near_copies_that_are_not_similar(spark, monkeypatch):
    """Each has edits of its own: all pairs share keys, few are similar."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(150):
        word = list(base)
        for j in rng.choice(160, int(rng.integers(2, 8)), replace=False):
            word[j] = f"own{i}x{j}"
        rows.append((i, " ".join(word)))
    monkeypatch.setattr(jaccard_join, "FREQUENT", 20)
    found = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == due(rows)


def test_chance_meetings_and_copies_stay_out_of_the_index(spark, monkeypatch):
    """Texts of too different sizes share a shingle, others are copies: nothing is left to meet."""
    counts = {}

    def counted(df, label, folder=None):
        table = tasks.stage(df, label, folder)
        counts[label] = table.count()
        return table

    monkeypatch.setattr(jaccard_join, "stage", counted)
    far = [(i, " ".join(["all of them share this", *(f"w{i}x{j}" for j in range(12 * 2**i))])) for i in range(4)]
    copies = [(10 + i, " ".join(f"copy{j}" for j in range(50))) for i in range(20)]
    found = jaccard_join.near_duplicates(frame(spark, far + copies)).collect()
    assert sorted(map(tuple, found), key=str) == due(far + copies)
    assert counts["index"] == 0


def test_rows_that_may_be_first_meetings():
    rng = np.random.default_rng(4)
    for trial in range(200):
        m = int(rng.integers(1, 60))
        group = np.sort(rng.integers(0, 1 + trial % 20, m))
        s1 = rng.integers(0, 1 << 40, m)
        s1[rng.random(m) < 0.3] = 7
        n = np.where(s1 == 7, 40, rng.integers(5, 80, m))
        place = np.where(s1 == 7, 5, rng.integers(0, 20, m) * n // 80)
        known = np.isin(group, [3])
        names = ["key", "flag", "s1", "place", "n"]
        columns = [group, np.zeros(m, np.int8), s1, place.astype(np.int32), n.astype(np.int32)]
        batch = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)
        stay = jaccard_join._may_meet(batch, group, known)
        assert len({(group[i], s1[i]) for i in stay}) == len(stay)
        found = {(group[i], s1[i]) for i in stay}
        every = set(zip(group.tolist(), s1.tolist(), strict=True))
        may = {
            (group[i], s1[i])
            for i in range(m)
            if known[i] or any(
                group[i] == group[j] and s1[i] != s1[j] and min(n[i], n[j]) * 100 >= 75 * max(n[i], n[j])
                and min(n[i] - place[i], n[j] - place[j]) * 175 >= 75 * (n[i] + n[j])
                for j in range(m)
            )
        }
        crowded = {g for g in set(group.tolist()) if sum(g == x for x, _ in every) > jaccard_join.MEETING}
        assert {x for x in found if x[0] not in crowded} == {x for x in may if x[0] not in crowded}
        assert all(x in found for x in every if x[0] in crowded)


def test_one_of_each_keeps_all_columns(spark):
    rows = documents() + ODD
    docs = frame(spark, rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    expected = {c for _, _, c in due(rows) if c is not None}
    assert ids == sorted([*expected, None, None], key=str)


def test_pipeline_drops_rows_not_ids(spark):
    word = [f"w{i}" for i in range(60)]
    a, near = " ".join(word), " ".join([*word[:30], "new", *word[31:]])
    b, c = ("one text of " + x * 9 for x in ("b ", "c "))
    rows = [(1, a), (2, near), (2, b), (2, b.upper()), (2, c), (None, a), (None, "alone"), (None, None), (3, "")]
    docs = frame(spark, rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = [(r["doc_id"], (r["text"] or "").strip().lower()) for r in kept.collect()]
    due = [(1, a), (2, b.strip()), (2, c.strip()), (None, "alone"), (None, ""), (3, "")]
    assert sorted(found, key=str) == sorted(due, key=str)


def test_empty_table(spark):
    assert jaccard_join.near_duplicates(frame(spark, [])).collect() == []
