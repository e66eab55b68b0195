"""Token store and packing: exact round trips, gapless places."""

from __future__ import annotations

import json
import random
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, frame
from tokenizers import Tokenizer

from reviewmart.llm import bpe, packing, token_store

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [(5, "b"), (5, "a"), (5, "a"), (None, "none"), (9, "<|endoftext|>x 's \u0301 \u00e9")]


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(PATH)

    def of(text, last):
        return [*tokenizer.encode(text or "", add_special_tokens=False).ids, last]

    return of


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_store_round_trip(spark, ids, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 500)
    rows = documents() + ODD
    token_store.write_tokens(frame(spark, rows), str(tmp_path / "s"), PATH, last_id=2)
    found = token_store.describe_tokens(spark, str(tmp_path / "s")).collect()
    due, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        own = ids(text, 2)
        due.append((doc, start, len(own), crc(own)))
        start += len(own)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == due
    assert token_store.read_ids(spark, str(tmp_path / "s"), 12) == [ids(dict(rows)[12], 2)]
    assert token_store.read_ids(spark, str(tmp_path / "s"), 5) == [ids(x, 2) for x in "aab"]
    assert token_store.read_ids(spark, str(tmp_path / "s"), 999) == []


def test_empty_store(spark, tmp_path):
    token_store.write_tokens(frame(spark, []), str(tmp_path / "s"), PATH, last_id=2)
    assert token_store.describe_tokens(spark, str(tmp_path / "s")).collect() == []


@pytest.mark.parametrize("limit", [16, 2048])
def test_packing_is_gapless_and_whole(spark, ids, limit):
    rows = [r for r in documents() + ODD if r[0] not in (5, None)] + [(5, "a"), (None, "none")]
    found = packing.pack(frame(spark, rows), PATH, last_id=0, limit=limit).collect()
    texts, total = dict(rows), 0
    pieces = {(r["doc_id"], r["piece"]): r for r in found}
    assert len(pieces) == len(found)
    for doc, text in texts.items():
        own = ids(text, 0)
        total += len(own)
        for piece in range(-(-len(own) // limit)):
            r = pieces.pop((doc, piece))
            part = own[piece * limit : (piece + 1) * limit]
            assert (r["start"], r["length"], r["ids_crc32"]) == (piece * limit, len(part), crc(part))
    assert not pieces
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    assert len(sequences) <= 1.02 * (-(-total // limit)) + 1


def test_empty_packing(spark):
    assert packing.pack(frame(spark, []), PATH, 0, 2048).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_close_to_the_least(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(6.5, 0.6 + seed / 4, 5000).astype(int), 1, 2048)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    table = packing.plan(histogram, 2048)
    for length, _, n, _, _ in table:
        histogram[length] -= n
    assert not any(histogram.values())
    used = (table[:, 2] + table[:, 3]).max()
    assert used <= 1.02 * -(-lengths.sum() // 2048) + 1


@pytest.mark.parametrize(
    ("histogram", "limit", "least"),
    [
        ({4: 600, 3: 1200}, 10, 600),
        ({1000: 300, 524: 600}, 2048, 300),
        ({n: 40 for n in range(400, 900)}, 2048, 6343),
    ],
)
def test_patterns_pack_what_best_fit_alone_does_not(monkeypatch, histogram, limit, least):
    def sequences(table):
        left = dict(histogram)
        for length, _, n, _, _ in table:
            left[length] -= n
        assert not any(left.values())
        return (table[:, 2] + table[:, 3]).max()

    assert least == -(-sum(length * n for length, n in histogram.items()) // limit)
    used = sequences(packing.plan(histogram, limit))
    assert used <= 1.02 * least
    monkeypatch.setattr(packing, "pattern_repeats", lambda *a, **k: [])
    assert sequences(packing.plan(histogram, limit)) > 1.03 * used


def test_patterns_never_cost_a_sequence(monkeypatch):
    rng = np.random.default_rng(1)
    for spread in (0.4, 0.8, 1.2):
        lengths = np.clip(rng.lognormal(6, spread, 3000).astype(int), 1, 2048)
        histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
        with_patterns = packing.plan(histogram, 2048)
        with monkeypatch.context() as m:
            m.setattr(packing, "pattern_repeats", lambda *a, **k: [])
            alone = packing.plan(histogram, 2048)
        used, without = ((t[:, 2] + t[:, 3]).max() for t in (with_patterns, alone))
        assert used <= without


def test_nnls_meets_the_conditions():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((12, 20)), rng.random(12)
        x = packing.nnls(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gradient <= 1e-6).all()
        assert abs(gradient[x > 0]).max(initial=0) < 1e-6


def test_plain_words_go_to_the_model_alone():
    whole = bpe.WordEncoder(PATH)
    rng = random.Random(5)
    plain = "aAzZ09.,'sStTrReEvVmMlLdD<|>_-!~\"&ÀßÖöÿÞðñéÉ"
    others = "µ²ªİΣςıſ¼ⅷ÷×\u0301\u0085ǅ中"
    words = ["".join(rng.choices(plain, k=rng.randint(1, 9))) for _ in range(5000)]
    odd = ["".join(rng.choices(plain + others, k=rng.randint(1, 9))) for _ in range(5000)]
    words += ["don't", "IT'S", "x'LLy", "'", "''s", "<|ENDOFTEXT|>", "end.of,text"]
    odd += ["x<|startoftext|>y", "<|endoftext|>", "'ſ"]
    for texts in (words, odd, []):
        due = [x.ids for x in whole.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert whole.ids_of(texts) == due
    whole.tokenizer = None
    with pytest.raises(AttributeError):
        whole.ids_of(odd)

    class Nothing:
        def encode_batch_fast(self, texts, add_special_tokens):
            assert texts == []
            return []

    whole.tokenizer = Nothing()
    assert all(whole.ids_of(words))


def test_words_of_another_tokenizer_are_not_split_here(tmp_path):
    made = json.loads(Path(PATH).read_text())
    made["normalizer"]["normalizers"].pop()  # keeps capitals
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(made))
    other = bpe.WordEncoder(str(path))
    words = ["Plain", "WORDS,", "don't"]
    due = [x.ids for x in other.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
    assert other.model is None and other.ids_of(words) == due


def test_words_are_told_apart_in_a_table_of_their_bytes(monkeypatch):
    words = [b"a", b"a\0", b"a\0\0", b"\0", "é".encode(), b"<|endoftext|>"]
    words += [b"x" * n for n in range(1, 40)] + [b"y" * 7 + bytes([n]) for n in range(33, 120)]
    words += [b"w%d" % n for n in range(200_000)]  # the table grows
    texts = [b" ".join(words), b"", b" ", b"\n".join(reversed(words[:500])), b"w7 w7"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    kept = bpe.Words()
    starts, ends, _ = bpe.word_bounds(data, offsets)
    number, new = kept.numbers(data, starts, ends)
    raw = data.tobytes()
    first = {}
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        assert first.setdefault(raw[a:b], number[i]) == number[i]
    assert sorted(first.values()) == list(range(len(first)))
    assert [first[raw[starts[i] : ends[i]]] for i in new] == list(range(len(first)))
    again, none = kept.numbers(data, starts, ends)
    assert (again == number).all() and none == []

    monkeypatch.setattr(bpe, "KEPT_WORDS", 100)
    whole = bpe.WordEncoder(PATH)
    texts = [x.decode() for x in texts[1:]] + [f"don't {n} Œuvre" for n in range(300)]
    for low in range(0, len(texts), 50):
        part = [x.encode() for x in texts[low : low + 50]]
        offsets = np.cumsum([0, *map(len, part)])
        ids, at = whole.encode(np.frombuffer(b"".join(part), np.uint8), offsets, 9)
        due = whole.tokenizer.encode_batch_fast(texts[low : low + 50], add_special_tokens=False)
        assert [x.tolist() for x in np.split(ids, at[1:-1])] == [[*x.ids, 9] for x in due]


def test_kept_words_take_little_memory():
    rng = np.random.default_rng(2)
    whole = bpe.WordEncoder(PATH)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    tracemalloc.start()
    for _ in range(3):
        data = letters[rng.integers(0, 26, 1_000_000)]
        data[9::10] = 32
        whole.encode(data, np.array([0, len(data)]), 0)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert whole.words.count > 290_000 and held / whole.words.count < 110


def test_a_packing_task_gives_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(packing, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words"])], names=["a", "b"])
    (out,) = packing._cut(iter([batch]), PATH, 0, 2048)
    assert out.num_rows == 1 and calls == [1]
