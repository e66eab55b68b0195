"""Byte-level BPE and token alignment against the libraries, run on whole texts."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from cases import documents, frame
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from reviewmart.llm import align_tokens, byte_bpe, segments

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
LETTERS = "a b'  \n\té1१₂sſ ​\x1c　 日本語xyz.,!!'re\U0001f642́<|"
ODD = [
    (5, "b"),
    (5, "a"),
    (None, "none"),
    (9, "<|endoftext|>x 's ́ é <s> <0x41> </s>"),
    (91, "a▁b"),
    (92, " two  spaces   and \n\n a line "),
    (93, "\x00\x01"),
    (94, "x" * 5000 + " " * 3000 + "y"),
]


def hexed(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def odd_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("slab", [segments.SLAB, 200])
def test_encode_decode_and_sums(spark, library, monkeypatch, slab):
    monkeypatch.setattr(segments, "SLAB", slab)
    rows = documents() + ODD
    docs = frame(spark, rows)
    due = sorted(((d, library.encode_ordinary(t or "")) for d, t in rows), key=str)
    encoded = byte_bpe.encode(docs, RANKS, PATTERN)
    assert sorted(map(tuple, encoded.collect()), key=str) == due
    decoded = byte_bpe.decode(encoded, RANKS, PATTERN).collect()
    assert sorted(((d, bytes(x)) for d, x in decoded), key=str) == sorted(((d, (t or "").encode()) for d, t in rows), key=str)
    sums = byte_bpe.describe(docs, RANKS, PATTERN).collect()
    assert sorted(map(tuple, sums), key=str) == sorted(
        ((d, len(i), hexed(" ".join(map(str, i)).encode()), hexed((t or "").encode())) for (d, t) in rows for i in [library.encode_ordinary(t or "")]),
        key=str,
    )


def test_empty_tables(spark):
    none = frame(spark, [])
    assert byte_bpe.describe(none, RANKS, PATTERN).collect() == []
    assert byte_bpe.encode(none, RANKS, PATTERN).collect() == []
    assert align_tokens.describe(none, A, B).collect() == []
    assert align_tokens.align(none, A, B).collect() == []


def test_prefixes_are_those_of_every_beginning(library):
    words = byte_bpe.encoder(RANKS, PATTERN).vocabulary
    rng = random.Random(3)
    for _ in range(200):
        raw = "".join(rng.choice("abestherinoAé  ") for _ in range(rng.randint(1, 40))).encode()
        whole = byte_bpe.Prefixes(words, raw)
        for n in range(1, len(raw) + 1):
            assert whole.last[n - 1] == words.merged(raw[:n])[-1]
        assert whole.ids() == words.merged(raw)
        grown = byte_bpe.Prefixes(words)
        for low in range(0, len(raw), 7):
            grown.append(raw[low : low + 7])
        assert grown.last == whole.last
        grown.cut(len(raw) // 2)
        grown.append(b"ing")
        assert grown.ids() == words.merged(raw[: len(raw) // 2] + b"ing")


def test_edited_texts(library):
    words = byte_bpe.encoder(RANKS, PATTERN).vocabulary
    rng = random.Random(7)
    for text in odd_texts(2, 400):
        kept = byte_bpe.EncodedText(words, PATTERN, text)
        for _ in range(6):
            start = rng.randint(0, len(kept.text))
            stop = rng.randint(start, len(kept.text))
            new = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 5)))
            due = kept.text[:start] + new + kept.text[stop:]
            kept.replace(start, stop, new)
            assert kept.text == due and kept.ids() == library.encode_ordinary(due)


def test_an_edit_encodes_only_what_it_reaches(library):
    words = byte_bpe.encoder(RANKS, PATTERN).vocabulary
    text = "some words of a text " * 5000
    kept = byte_bpe.EncodedText(words, PATTERN, text)
    assert kept.encoded == len(text)
    kept.replace(50_000, 50_003, "new")
    kept.append("and more")
    assert kept.encoded < len(text) + 60
    assert kept.ids() == library.encode_ordinary(kept.text)
    with pytest.raises(ValueError, match="no characters"):
        kept.replace(5, len(kept.text) + 1, "")


def test_every_way_to_split_is_the_library_s(library):
    own = byte_bpe.encoder(RANKS, PATTERN)
    for text in odd_texts(0, 3000):
        assert [i for _, x in own.of(pa.array([text])) for i in x.tolist()] == library.encode_ordinary(text)


def test_a_worker_starts_anew_when_it_keeps_much(library, monkeypatch):
    monkeypatch.setattr(segments, "KEPT_SEGMENTS", 5)
    own = byte_bpe.Encoder(RANKS, PATTERN)
    texts = odd_texts(4, 50)
    for text in [*texts, *texts]:
        assert [i for _, x in own.of(pa.array([text])) for i in x.tolist()] == library.encode_ordinary(text)


@pytest.fixture(scope="module")
def plain():
    """Groups as [(ids of A, ids of B)] of a text, from whole texts' tokens."""
    a_tokenizer = Tokenizer.from_file(A)
    a_tokenizer.encode_special_tokens = True
    b_tokenizer = SentencePieceProcessor(model_file=B)
    letters = align_tokens.byte_letters()

    def a_bytes(i):
        return bytes(letters[x] for x in a_tokenizer.id_to_token(i))

    def b_bytes(i):
        piece = b_tokenizer.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_tokenizer.is_byte(i) else piece.replace("▁", " ").encode()

    def of(text):
        if not text:
            return []
        a = a_tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = b_tokenizer.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            return []
        out, x, y, n, m = [], [], [], 0, 0
        b = list(b)
        for i in a:
            x.append(i)
            n += len(a_bytes(i))
            while m < n:
                y.append(b.pop(0))
                m += len(b_bytes(y[-1]))
            if m == n:
                out.append((x, y))
                x, y = [], []
        return out

    return of


def due_rows(rows, plain):
    groups = [(d, plain(t)) for d, t in rows]
    counts = Counter((x[-1], y[-1]) for _, own in groups for x, y in own)
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for d, own in groups:
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        found = [(x[-1], y[-1]) for x, y in own]
        out.append(
            {
                "doc_id": d,
                "n_a": sum(len(x) for x, _ in own),
                "n_b": sum(len(y) for _, y in own),
                "n_groups": len(own),
                "n_links": len(found),
                "n_best": sum(counts[p] == most[p[1]] for p in found),
                "count_sum": sum(counts[p] for p in found),
                "groups_sha256": hexed(listed.encode()) if own else "",
            }
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("slab", [segments.SLAB, 200])
def test_alignment(spark, plain, monkeypatch, slab):
    monkeypatch.setattr(segments, "SLAB", slab)
    rows = documents() + ODD + [(200 + i, t) for i, t in enumerate(odd_texts(6, 300))]
    found = [r.asDict() for r in align_tokens.describe(frame(spark, rows), A, B).collect()]
    due = due_rows(rows, plain)
    order = list(due[0])
    assert sorted(({c: r[c] for c in order} for r in found), key=str) == due


def test_alignment_s_groups(spark, plain):
    rows = documents() + ODD
    texts = Counter((d, str(plain(t))) for d, t in rows)
    found = []
    for r in align_tokens.align(frame(spark, rows), A, B).collect():
        groups = [([], []) for _ in set(r["a_group"])]
        for ids, at, side in ((r["a"], r["a_group"], 0), (r["b"], r["b_group"], 1)):
            for i, group in zip(ids, at, strict=True):
                groups[group][side].append(i)
        found.append((r["doc_id"], str(groups)))
    assert Counter(found) == texts


def test_pairs_are_bounded_by_the_vocabularies(spark):
    rows = documents() + [(200 + i, t) for i, t in enumerate(odd_texts(8, 300))]
    own = align_tokens.aligner(A, B)
    counts = align_tokens.link_counts(align_tokens.summarize(frame(spark, rows), A, B), own.b.size)
    for a, b, _ in counts.collect():
        x, y = own.a.tokenizer.bytes_of[a], own.b.tokenizer.bytes_of[b]
        assert x.endswith(y) or y.endswith(x)
