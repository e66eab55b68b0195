"""Substring and suffix dedup against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, frame, split

from reviewmart.llm import repeats, substring_dedup, suffix_dedup


def due_words(rows, length):
    texts = [(d, split(t)) for d, t in rows]
    seen = Counter(tuple(w[i : i + length]) for _, w in texts for i in range(len(w) - length + 1))
    out = []
    for doc, w in texts:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def due_bytes(rows, length):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(b[i : i + length])
        gone = np.cumsum(gone)[:-1] > 0
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


ODD = [(5, "same id " * 60), (5, "same id " * 60), (5, "other " * 3), (None, "no id " * 70), (None, None)]


@pytest.mark.parametrize("extra", [[], ODD])
def test_words_against_brute_force(spark, extra):
    rows = documents() + extra
    found = substring_dedup.strip_repeats(frame(spark, rows)).drop("kept").collect()
    assert sorted(map(tuple, found), key=str) == due_words(rows, 35)


@pytest.mark.parametrize("extra", [[], ODD])
def test_bytes_against_brute_force(spark, extra):
    rows = documents() + extra
    found = suffix_dedup.strip_repeats(frame(spark, rows)).drop("kept").collect()
    assert sorted(map(tuple, found), key=str) == due_bytes(rows, 100)


def test_keys_with_too_many_pieces_are_taken_apart(spark, monkeypatch):
    # A shard of 200 words: the passage's keys, with other words around it, exceed it.
    real = repeats.Windows
    monkeypatch.setattr(substring_dedup, "Windows", lambda **k: real(**{**k, "shard": 200}))
    rows = documents()
    found = substring_dedup.strip_repeats(frame(spark, rows)).drop("kept").collect()
    assert sorted(map(tuple, found), key=str) == due_words(rows, 35)


def test_byte_keys_with_too_many_pieces_are_taken_apart(spark, monkeypatch):
    real = repeats.Windows
    monkeypatch.setattr(suffix_dedup, "Windows", lambda **k: real(**{**k, "shard": 600}))
    rows = documents() + ODD
    found = suffix_dedup.strip_repeats(frame(spark, rows)).drop("kept").collect()
    assert sorted(map(tuple, found), key=str) == due_bytes(rows, 100)


def test_empty_table(spark):
    empty = frame(spark, [])
    assert substring_dedup.strip_repeats(empty).collect() == []
    assert suffix_dedup.strip_repeats(empty).collect() == []


@pytest.mark.parametrize("length", [1, 3, 7, 8, 20])
def test_windows_in_prefix_order_are_cut_where_they_differ(length):
    rng = np.random.default_rng(length)
    for trial in range(60):
        text = np.append(rng.integers(0, 2 + trial % 4, rng.integers(0, 80)), 0)
        if trial % 3 == 0:  # long repeats
            text = np.append(np.tile(text, 3), 0)
        order = suffix_dedup.prefix_order(text, length)
        assert sorted(order) == list(range(len(text)))
        padded = [*text.tolist(), *[0] * length]
        strings = [tuple(padded[i : i + length]) for i in order]
        assert strings == sorted(strings)
        cut = suffix_dedup.boundaries(text[order - 1], length)
        whole = [a for a, s in enumerate(strings) if 0 not in s]
        for a, b in zip(whole, whole[1:], strict=False):
            assert (strings[a] == strings[b]) == (not cut[a + 1 : b + 1].any())


@pytest.mark.parametrize("length", [3, 7, 8, 9, 20, 100])
def test_boundaries_from_packed_strings_cut_the_same_windows(length):
    rng = np.random.default_rng(length)
    for trial in range(90):
        pieces = [rng.integers(1, 257 if trial % 5 == 0 else 2 + trial % 4, rng.integers(1, 60)) for _ in range(4)]
        pieces += [np.tile(pieces[0], 8), np.append(pieces[1], pieces[0]), pieces[2]]
        text = np.concatenate([np.append(x, 0) for x in pieces])
        key = suffix_dedup.packed(text)
        order = suffix_dedup.prefix_order(text, length, key)
        assert order.tolist() == suffix_dedup.prefix_order(text, length).tolist()
        cut = suffix_dedup.boundaries(text[order - 1], length, key[order])
        padded = [*text.tolist(), *[0] * length]
        strings = [tuple(padded[i : i + length]) for i in order]
        whole = [a for a, s in enumerate(strings) if 0 not in s]
        for a, b in zip(whole, whole[1:], strict=False):
            assert (strings[a] == strings[b]) == (not cut[a + 1 : b + 1].any())


def test_boundaries_against_plain_comparison():
    rng = np.random.default_rng(0)
    for trial in range(60):
        text = np.append(rng.integers(0, 2 + trial % 4, rng.integers(5, 50)), 0)
        separators = np.flatnonzero(text == 0)
        apart = text + len(separators)
        apart[separators] = np.arange(len(separators))
        order = substring_dedup.suffix_array(apart)
        assert list(order) == sorted(range(len(text)), key=lambda i: list(apart[i:]))
        cut = suffix_dedup.boundaries(text[order - 1], 3)
        strings = [tuple(text[i : i + 3]) for i in order]
        whole = [len(s) == 3 and 0 not in s for s in strings]
        for a in range(len(text)):
            for b in range(a + 1, len(text)):
                if whole[a] and whole[b]:
                    assert (strings[a] == strings[b]) == (not cut[a + 1 : b + 1].any())


def test_backward_search_counts_occurrences():
    rng = random.Random(0)
    for _ in range(30):
        text = [rng.randint(1, 4) for _ in range(60)] + [0]
        index = substring_dedup.FmIndex(np.array(text), np.ones(len(text), np.int64))
        for _ in range(10):
            a = rng.randint(0, 50)
            pattern = text[a : a + rng.randint(1, 6)]
            low, high = np.array([0]), np.array([index.size])
            for symbol in reversed(pattern):
                low, high = index.extend(np.array([symbol]), low, high)
            n = sum(text[i : i + len(pattern)] == pattern for i in range(len(text)))
            assert high[0] - low[0] == n


def test_windows_of_many_texts_are_laid_out_at_once():
    rng = np.random.default_rng(3)
    places, sizes, due = [], [], []
    for i in range(70):
        n = int(rng.integers(0, 300)) if i % 5 else 0
        sizes.append(n)
        rows, at = [], 0
        while n - at >= 20:
            m = int(min(rng.integers(1, 20), n - at - 9))
            hits = np.packbits(rng.random(m) < 0.2).tobytes()
            rows.append({"start": at, "hits": hits})
            at += m
        places.append(rows if i % 7 else None)
        due.append(repeats.covered(places[-1], n, 10))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("hits", pa.binary())]))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    whole = pa.array([None, *places, None], kind)
    found = suffix_dedup.gone_bytes(whole.slice(1, 70), offsets, 10)
    assert found.tolist() == np.concatenate(due).tolist()
    # None of the windows is a Python object of its own.
    assert "to_pylist" not in suffix_dedup._strip.__code__.co_names
