"""Personal data: exact rules, and a linear-chain CRF that finds what the rules miss.

The CRF labels the tokens of a line (runs of letters, runs of digits, single signs) from
their word shapes and those of their neighbours.  It is trained on a small table of
labelled lines (``pii_examples``) and decoded by Viterbi for many lines at once.  It finds
forms the rules miss, and secrets, of which there is no rule.  Only stretches around a
digit, ``@`` or a bracketed "at" are decoded: all other labels are ruled out elsewhere, as
no kind of personal data here does without all three.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm import pii_examples
from reviewmart.llm.tasks import chunks, give_back, ship

KINDS = ("email", "ip", "card", "phone", "secret")
RULED = 4  # kinds the rules know
Span = tuple[int, int, int]  # kind, start, end

# Training takes so many labelled lines at most, picked by their hash.
LABELLED = 4000
ROUNDS = 120
# A line is decoded where a trigger is so many code points away at most, in pieces of
# ``CORE`` with as much around them.
REACH, CORE = 160, 2000
# Code points whose tokens are in memory, and tokens (padding too) decoded at once.
GATHERED, DECODED = 1 << 18, 1 << 16

# The rules, fixed by contract.  Possessive repeats and look-behinds keep them linear in
# the text; they find what the plain patterns find.
_LOCAL = "A-Za-z0-9._%+-"
_EMAIL = rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
EMAIL_HERE = re.compile(_EMAIL)
EMAIL = re.compile(rf"(?<![{_LOCAL}]){_EMAIL}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# What the CRF's values have: a digit, @, or a bracketed "at".
_AT = r"[\[({] ?at ?[\])}]"
TRIGGER = re.compile(rf"[0-9@]+|{_AT}")
TRIGGER_BYTES = b"0123456789@[({"


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def is_card(text: str) -> bool:
    number = _digits(text)
    return 13 <= len(number) <= 19 and luhn(number)


def is_ip(text: str) -> bool:
    parts = re.findall("[0-9]+", text)
    # Long parts are not converted: their digits may be any number.
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)


def is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        # Right behind a match a run may go on; elsewhere one begins at its first sign.
        found = (EMAIL_HERE.match(text, at) if at else None) or EMAIL.search(text, at)
        if not found:
            return
        yield found.span()
        at = found.end()


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap; failing ones dropped."""
    out = [(0, *x) for x in _emails(text)] if "@" in text else []
    for kind, (pattern, good) in enumerate(((IP, is_ip), (CARD, is_card), (PHONE, is_phone)), 1):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if good(m.group())]
    return out


# Tokens and their shapes

_CLASS = np.full(128, 10, np.int64)  # other signs
_CLASS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 0
_CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_CLASS[[ord(c) for c in "0123456789"]] = 2
for _i, _c in enumerate("@.-+()", 3):
    _CLASS[ord(_c)] = _i
_CLASS[[9, 10, 11, 12, 13, 32]] = -1
CLASSES, MIXED = 11, 9
SIZES = np.array([2, 3, 4, 5, 7, 13, 20])
CODES = CLASSES * 8 * 2
FEATURES = 5 * (CODES + 1) + (CLASSES + 1) ** 3
LABELS = 1 + 2 * len(KINDS)


def tokens(line: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each token in code points, and its features."""
    code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = np.where(code < 128, _CLASS[np.minimum(code, 127)], 0)
    group = np.where(kind == 1, 0, kind)  # letters run together
    new = np.ones(len(code), bool)
    new[1:] = (group[1:] != group[:-1]) | (group[1:] > 2)
    starts = np.flatnonzero(new & (kind >= 0))
    ends = np.append(np.flatnonzero(new), len(code))
    ends = ends[np.searchsorted(ends, starts, "right")]
    upper = np.concatenate([[0], np.cumsum(kind == 1)])
    uppers = upper[ends] - upper[starts]
    own = kind[starts]
    letters = own <= 1
    own = np.where(letters & (uppers == ends - starts), 1, own)
    own = np.where(letters & (uppers > 0) & (uppers < ends - starts), MIXED, own)
    own = np.where(letters & (uppers == 0), 0, own)
    spaced = np.append([-1], kind)[starts] < 0
    shape = (own * 8 + np.searchsorted(SIZES, ends - starts, "right")) * 2 + spaced
    padded = np.concatenate([[CODES] * 2, shape, [CODES] * 2])
    n = len(starts)
    columns = [padded[i : i + n] + i * (CODES + 1) for i in range(5)]
    around = np.concatenate([[CLASSES], own, [CLASSES]])
    triple = (around[:n] * (CLASSES + 1) + around[1 : n + 1]) * (CLASSES + 1) + around[2:]
    columns.append(triple + 5 * (CODES + 1))
    return starts, ends, np.stack(columns, 1)


def labels(starts: np.ndarray, ends: np.ndarray, spans: Sequence[Span]) -> np.ndarray:
    """0 outside, 1 + 2 kind for a span's first token, 2 + 2 kind for its others."""
    out = np.zeros(len(starts), np.int64)
    for kind, begin, end in spans:
        inside = np.flatnonzero((starts >= begin) & (ends <= end))
        out[inside] = 2 + 2 * kind
        out[inside[:1]] = 1 + 2 * kind
    return out


# The CRF


class Crf:
    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights = weights  # feature, label
        self.steps = steps  # label, next label

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), LABELS))
        for column in features.T:
            out += self.weights[column]
        return out

    def decode(self, lines: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each line's features; lines of like length go together."""
        out: list = [None] * len(lines)
        order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
        while order:
            longest = max(len(lines[order[-1]]), 1)
            take = max(DECODED // longest, 1)
            batch, order = order[-take:], order[:-take]
            for i, path in zip(batch, self._viterbi([lines[i] for i in batch]), strict=True):
                out[i] = path
        return out

    def _viterbi(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        size = np.array([len(x) for x in lines])
        n, longest = len(lines), int(size.max(initial=0))
        if not longest:
            return [np.zeros(0, np.int64)] * n
        emitted = np.zeros((longest, n, LABELS))
        inside = np.arange(longest)[:, None] < size
        row = np.concatenate([np.arange(len(x)) for x in lines])
        emitted[row, np.repeat(np.arange(n), size)] = self.emissions(np.concatenate(lines))
        best = emitted[0]
        back = np.zeros((longest, n, LABELS), np.int8)
        for t in range(1, longest):
            through = best[:, :, None] + self.steps
            back[t] = through.argmax(1)
            step = through.max(1) + emitted[t]
            best = np.where(inside[t][:, None], step, best)
        paths = np.zeros((longest, n), np.int64)
        label = best.argmax(1)
        for t in range(longest - 1, -1, -1):
            paths[t] = label
            earlier = back[t][np.arange(n), label]
            label = np.where(inside[t] & (t > 0), earlier, label)
        return [paths[: size[i], i] for i in range(n)]


def _forward_backward(emitted, steps, inside):
    """Label chances of each token, and expected steps, of padded lines, longest first."""
    longest, _, k = emitted.shape
    top = emitted.max(2, keepdims=True)
    e, s = np.exp(emitted - top), np.exp(steps - steps.max())
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    alpha[0] = e[0] / e[0].sum(1, keepdims=True)
    lines = inside.sum(1)  # that reach this token
    for t in range(1, longest):
        n = lines[t]
        a = alpha[t - 1, :n] @ s * e[t, :n]
        alpha[t, :n] = a / a.sum(1, keepdims=True)
    expected = np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        n = lines[t]
        before, right = alpha[t - 1, :n], beta[t, :n] * e[t, :n]
        b = right @ s.T
        expected += s * (before.T @ (right / (before * b).sum(1, keepdims=True)))
        beta[t - 1, :n] = b / b.sum(1, keepdims=True)
    chance = alpha * beta
    return chance / np.maximum(chance.sum(2, keepdims=True), 1e-300), expected


def fit(lines: Sequence[tuple[str, Sequence[Span]]], rounds: int = ROUNDS) -> Crf:
    """Maximum likelihood with an L2 penalty, by Adam steps over all lines.

    Without any line there is nothing to learn, and all tokens are outside.
    """
    crf = Crf(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)))
    crf.weights[:, 0] = 1e-6
    made = [(tokens(text), spans) for text, spans in lines]
    made = [(t, labels(t[0], t[1], spans)) for t, spans in made if len(t[0])]
    made.sort(key=lambda x: -len(x[1]))
    if not made:
        return crf
    size = np.array([len(x) for _, x in made])
    n, longest = len(made), int(size.max())
    features = np.concatenate([t[2] for t, _ in made])
    gold = np.concatenate([x for _, x in made])
    line = np.repeat(np.arange(n), size)
    place = np.concatenate([np.arange(x) for x in size])
    inside = np.arange(longest)[:, None] < size
    same = line[1:] == line[:-1]
    seen = np.zeros((LABELS, LABELS))
    np.add.at(seen, (gold[:-1][same], gold[1:][same]), 1)
    # Each column's tokens in order of their feature, so that a sum per feature is a run.
    sorts = [np.argsort(column, kind="stable") for column in features.T]
    runs = [np.unique(c[o], return_index=True) for c, o in zip(features.T, sorts, strict=True)]
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (crf.weights, crf.steps)]
    for step in range(1, rounds + 1):
        emitted = np.zeros((longest, n, LABELS))
        emitted[place, line] = crf.emissions(features)
        chance, expected = _forward_backward(emitted, crf.steps, inside)
        error = chance[place, line]
        error[np.arange(len(gold)), gold] -= 1
        down = np.zeros_like(crf.weights)
        for order, (own, first) in zip(sorts, runs, strict=True):
            down[own] += np.add.reduceat(error[order], first)
        for x, g, m in zip(
            (crf.weights, crf.steps), (down, expected - seen), moments, strict=True
        ):
            g = g / n + 1e-4 * x
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            x -= 0.3 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return crf


# Finding


def _stretches(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Parts of a line from ``REACH`` before a trigger to ``REACH`` behind it, joined."""
    found = TRIGGER.search(text, begin, end)
    while found:
        low, high = max(found.start() - REACH, begin), found.end() + REACH
        while (found := TRIGGER.search(text, found.end(), end)) and found.start() - REACH <= high:
            high = found.end() + REACH
        yield low, min(high, end)


def _pieces(text: str) -> Iterator[tuple[int, int, int, int]]:
    """What is decoded: begin and end, and between which places its spans may begin."""
    begin = 0
    while found := TRIGGER.search(text, begin):
        low = text.rfind("\n", begin, found.start()) + 1 or begin
        end = text.find("\n", found.end())
        end = len(text) if end < 0 else end
        for a, b in _stretches(text, low, end):
            for core in range(a, b, CORE):
                stop = min(core + CORE, b)
                yield max(a, core - REACH), min(b, stop + REACH), core, stop
        begin = end


def _plausible(kind: int, text: str) -> bool:
    """Whether a found value is whole: shapes tell neither a check digit nor a size."""
    if kind == 0:
        plain = re.sub(rf" *(?:{_AT}|@) *", "@", re.sub(r" *(?:[\[({] ?dot ?[\])}]|\.) *", ".", text))
        return EMAIL.fullmatch(plain) is not None
    if kind == 4:
        value = text.isascii() and text.isalnum() and len(text) >= 16
        return value and any(c.isdigit() for c in text) and any(c.isalpha() for c in text)
    return not any(c.isalpha() for c in text) and (is_ip, is_card, is_phone)[kind - 1](text)


def _found(path: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Kind, first and last token of each run of labels."""
    starts = (path > 0) & (path % 2 == 1)
    inside = (path > 0) & ~starts
    # Labels that go on begin a run of their own behind another kind, or none.
    inside[1:] &= (path[:-1] > 0) & ((path[1:] - 1) // 2 == (path[:-1] - 1) // 2)
    inside[:1] = False
    first = np.flatnonzero((path > 0) & ~inside)
    outside = np.append(np.flatnonzero(path == 0), len(path))
    ends = np.minimum(np.append(first[1:], len(path)), outside[np.searchsorted(outside, first)])
    for a, b in zip(first, ends, strict=True):
        yield (int(path[a]) - 1) // 2, int(a), int(b) - 1


def added_spans(crf: Crf, texts: Sequence[str], base: Sequence[list[Span]]) -> list[list[Span]]:
    """Spans the CRF finds apart from the base ones, per text; they never overlap.

    A line is decoded in pieces, so a text of any length takes bounded memory; a span
    that begins in a piece ends at most ``REACH`` behind it.
    """
    out: list[list[Span]] = [[] for _ in texts]
    taken = [sorted((a, b) for _, a, b in spans) for spans in base]
    last = [0] * len(texts)
    gathered, held = [], 0

    def decode() -> None:
        cut = [tokens(texts[i][a:b]) for i, a, b, _, _ in gathered]
        paths = crf.decode([features for _, _, features in cut])
        for (i, begin, _, low, high), (starts, ends, _), path in zip(gathered, cut, paths, strict=True):
            for kind, first, end in _found(path):
                a, b = begin + int(starts[first]), begin + int(ends[end])
                if not (low <= a < high and a >= last[i]):
                    continue
                # Base spans of several kinds may overlap each other; few stand in a text.
                near = taken[i][: bisect.bisect_left(taken[i], (b, 0))]
                if all(y <= a for _, y in near) and _plausible(kind, texts[i][a:b]):
                    out[i].append((kind, a, b))
                    last[i] = b

    for i, text in enumerate(texts):
        for begin, end, low, high in _pieces(text):
            gathered.append((i, begin, end, low, high))
            held += end - begin
            if held >= GATHERED:
                decode()
                gathered, held = [], 0
    decode()
    return out


def _join(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


FOUND = ", ".join(
    ["doc_id long", *(f"n_{k} long" for k in KINDS[:RULED]), "base_sha256 string", "spans string",
     "n_secret long", "n_added long"]
)


def _find(batches: Iterator[pa.RecordBatch], crf: Crf) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    trigger = np.zeros(256, bool)
    trigger[list(TRIGGER_BYTES)] = True
    for batch in batches:
        for rows, data, offsets in chunks(batch):
            marks = np.concatenate([[0], np.cumsum(trigger[data])])
            some = np.flatnonzero(marks[offsets[1:]] > marks[offsets[:-1]])
            raw = data.tobytes()
            texts = [raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace") for i in some]
            base = [base_spans(x) for x in texts]
            added = added_spans(crf, texts, base)
            counts = np.zeros((RULED, rows.num_rows), np.int64)
            found = np.zeros((2, rows.num_rows), np.int64)
            sums, spans = [nothing] * rows.num_rows, [""] * rows.num_rows
            for i, own, more in zip(some, base, added, strict=True):
                for kind, _, _ in own:
                    counts[kind, i] += 1
                sums[i] = hashlib.sha256(_join(own).encode()).hexdigest()
                spans[i] = _join([*own, *more])
                found[:, i] = sum(k == KINDS.index("secret") for k, _, _ in more), len(more)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *map(pa.array, counts), pa.array(sums), pa.array(spans),
                 *map(pa.array, found)],
                names=[x.split()[0] for x in FOUND.split(", ")],
            )


def examples(spark: SparkSession) -> DataFrame:
    """The small labelled table (line, spans) that the library brings along."""
    rows = [
        (line, ",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        for line, spans in pii_examples.labelled()
    ]
    return spark.createDataFrame(rows, "line string, spans string")


def parse_spans(spans: str) -> list[Span]:
    parts = [x.split(":") for x in spans.split(",") if x]
    return [(KINDS.index(k), int(a), int(b)) for k, a, b in parts]


def train(labelled: DataFrame, most: int = LABELLED) -> Crf:
    """Fit a CRF to a table of (line, spans); ``most`` lines, picked by their hash.

    Spans are ``kind:start:end``, comma-joined; a null or empty line or spans count as
    empty, and repeated rows as one.
    """
    order = [F.xxhash64("line"), "line", "spans"]
    rows = labelled.select(F.coalesce("line", F.lit("")).alias("line"), F.coalesce("spans", F.lit("")).alias("spans"))
    rows = rows.distinct().orderBy(*order).limit(most).collect()
    return fit([(r["line"], parse_spans(r["spans"])) for r in rows])


def find(docs: DataFrame, crf: Crf) -> DataFrame:
    """``doc_id``, the number of rule-found spans of each kind, ``base_sha256``, ``spans``,
    the number of secrets and of all spans that only the CRF has found.

    Every whole text of (doc_id, text) is searched; a null text is empty.  ``spans`` has
    the rules' and the CRF's, which never overlap them.  Rows that share a ``doc_id``
    are searched one by one; other columns are ignored; an empty table gives none.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(partial(_find, crf=crf), FOUND)


def _mask(batches: Iterator[pa.RecordBatch], crf: Crf, text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(text).to_pylist()
        some = [i for i, x in enumerate(texts) if x and TRIGGER.search(x)]
        base = [base_spans(texts[i]) for i in some]
        added = added_spans(crf, [texts[i] for i in some], base)
        for i, own, more in zip(some, base, added, strict=True):
            out, at = [], 0
            # Kinds may overlap each other: a span that begins inside another is joined to it.
            for kind, a, b in sorted([*own, *more], key=lambda s: (s[1], -s[2])):
                if a >= at:
                    out += [texts[i][at:a], f"<{KINDS[kind].upper()}>"]
                at = max(at, b)
            texts[i] = "".join([*out, texts[i][at:]])
        columns = list(batch.columns)
        columns[text] = pa.array(texts, batch.schema.field(text).type)
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    give_back()


def mask(docs: DataFrame, crf: Crf) -> DataFrame:
    """All rows and columns, with ``<KIND>`` in place of personal data in ``text``.

    A null or empty text stays as it is; other columns, whatever their names, do too.
    """
    ship(docs.sparkSession)
    text = docs.columns.index("text")
    return docs.mapInArrow(partial(_mask, crf=crf, text=text), docs.schema)
