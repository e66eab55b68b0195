"""Small documents with every awkward case, and plain reckonings of what is due."""

from __future__ import annotations

import random

# Columns that operators use inside, as extra columns of the input.
CLASHING = ["key", "h", "n", "m", "z", "rep", "component", "block", "gram", "accepted", "part"]


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("ab cd ef gh Ij kl Mn op qr st uv wx yz".split()) + str(rng.randint(0, 60)) for _ in range(n))


def documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text) with nulls, blanks, copies, near copies, shared passages, periods."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 120)) for _ in range(25)]
    passage = words(rng, 60)
    near = base[3].split() + words(rng, 100).split()
    texts = [
        *base,
        base[0],
        base[0].upper(),
        base[7],
        " ".join(near),
        " ".join([*near[:-2], "new", *near[-2:]]),
        " ".join([*near[:60], "other", *near[61:]]),
        *(f"{words(rng, 5)} {passage} {words(rng, 5)}" for _ in range(4)),
        passage,
        "x " * 200,
        "the cat " * 90,
        "\t\n  \x0b\x0c\r ",
        "",
        None,
        "é" * 300,
        "one two three",
        "ONE two\tthree",
        "a\x1cb\u00a0c " * 40,
        words(rng, 3000),
    ]
    return list(enumerate(texts, 10))


def frame(spark, rows, clashing: bool = True, kind: str = "long"):
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    if clashing:
        for i, name in enumerate(CLASHING):
            df = df.selectExpr("*", f"{i} AS `{name}`")
    return df.repartition(3)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
