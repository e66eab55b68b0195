"""Top-k, URL filter, decontamination: against plain reckonings, with odd rows."""

from __future__ import annotations

import random

import pytest
import xxhash
from cases import documents, frame, split

from reviewmart.llm import decontaminate, topk, url_filter
from reviewmart.llm.queries import RULES

VECTORS = "vec_id long, terms array<long>, weights array<long>"


def test_topk_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 7)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = random.Random(2)
    rows = []
    for i in range(40):
        terms = rng.sample(range(8), rng.randint(0, 8))
        rows.append((i, terms, [rng.randint(-3, 3) for _ in terms]))
    rows += [(40, [1, 1], [2, 1]), (41, [], []), (3, rows[3][1], rows[3][2])]
    odd = [(None, [1], [1]), (50, None, [1]), (51, [1], None), (52, [None], [1]), (53, [1], [None])]
    table = spark.createDataFrame(rows + odd, VECTORS).selectExpr("*", "1 AS score", "2 AS block")
    queries = table.where("vec_id % 5 = 0 OR vec_id IS NULL")
    found = topk.top_k(queries, table, 4).collect()

    def score(a, b):
        return sum(x * y for i, x in zip(*a, strict=True) for j, y in zip(*b, strict=True) if i == j)

    due = []
    for q, *a in rows:
        if q % 5 == 0:
            best = sorted((-score(a, b), v) for v, *b in rows if v != q)[:4]
            due += [(q, rank, v, -s) for rank, (s, v) in enumerate(best, 1)]
    assert sorted(map(tuple, found)) == sorted(due)
    assert topk.top_k(table.where("false"), table, 4).collect() == []
    assert topk.top_k(queries, table.where("false"), 4).collect() == []
    few = topk.top_k(queries.where("vec_id = 0"), table.where("vec_id IN (0, 1)"), 4).collect()
    assert [(r["query_id"], r["vec_id"]) for r in few] == [(0, 1)]


def test_repeated_query_rows_have_ranks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 2)
    table = spark.createDataFrame([(i, [1, 2], [i, 10 - i]) for i in range(1, 8)], VECTORS)
    asked = [(100, [1], [1]), (100, [1], [1]), (100, [2], [1]), (200, [1], [1])]
    queries = spark.createDataFrame(asked, VECTORS).coalesce(1)
    found = topk.top_k(queries, table, 3).collect()
    up, down = ([(r, v, w) for r, v, w in zip((1, 2, 3), x, y)] for x, y in (((7, 6, 5), (7, 6, 5)), ((1, 2, 3), (9, 8, 7))))
    due = [(100, *x) for x in [*up, *up, *down]] + [(200, *x) for x in up]
    assert sorted(map(tuple, found)) == sorted(due)


def test_urls(spark):
    cases = {
        "http://A.Example.ORG/es/1?x": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12#t": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://spam-farm.example.org/en/2": ("spam-farm.example.org", "/en/2", "org/", "allow"),
        "http://org/": ("org", "/", "org/", "allow"),
        "http://org": ("org", "", None, "allow"),
        "x://b.com/de/://y": ("b.com", "/de/://y", "com/de/", "block"),
        "x://bcom/de/": ("bcom", "/de/", None, "allow"),
        "https://www.Free-Bets.example.com/en/1": ("www.free-bets.example.com", "/en/1", None, "block"),
        "https://notfree-bets.example.com/": ("notfree-bets.example.com", "/", None, "allow"),
        "https://c.net/bad/page?q": ("c.net", "/bad/page", None, "block"),
        "https://c.net/bad": ("c.net", "/bad", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://" + "x" * 50_000: ("x" * 50_000, "", None, "allow"),
        "http://" + "a." * 50_000 + "net/y": ("a." * 50_000 + "net", "/y", None, "allow"),
        "http://" + "a." * 50_000 + "free-bets.example.com": ("a." * 50_000 + "free-bets.example.com", "", None, "block"),
        "http://c.net./bad/page": ("c.net.", "/bad/page", None, "allow"),
        "http://" + "." * 50_000: ("." * 50_000, "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(0, next(iter(cases))), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    pages = pages.selectExpr("*", "'x' AS host", "'y' AS verdict", "1 AS listed")
    blocked = [("free-bets.example.com",), ("c.net/bad/page",), ("",), (None,), ("c.net/bad/page",)]
    name = url_filter.ship_list(spark, spark.createDataFrame(blocked, "entry string"))
    found = url_filter.judge(pages, RULES, name).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((i, *cases[u]) for i, u in rows), key=str)
    assert url_filter.judge(pages.where("false"), RULES, name).collect() == []
    none = url_filter.ship_list(spark, spark.createDataFrame([], "entry string"))
    assert {r["verdict"] for r in url_filter.judge(pages.where("page_id = 9"), RULES, none).collect()} == {"allow"}


def test_probes_are_all_that_may_be_listed():
    rng = random.Random(4)
    for _ in range(500):
        host, path = ("".join(rng.choice("a.é") for _ in range(rng.randint(1, 9))) for _ in range(2))
        labels, longest = host.split("."), rng.randint(0, 12)
        due = {".".join(labels[i:]) for i in range(len(labels))} | {host + path}
        due = {x.encode() for x in due if len(x.encode()) <= longest}
        assert set(url_filter._probes(host, path, longest)) == due


def test_a_digest_that_two_texts_share_blocks_only_the_listed_one(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda x: len(x))
    url_filter.write_digests([b"abc", b"abd", b"xy"], str(tmp_path / "d"))
    held = url_filter.DigestArray(str(tmp_path / "d"))
    assert held.contains([b"abc", b"abd", b"abe", b"xy", b"q", b""]).tolist() == [1, 1, 0, 1, 0, 0]


def shingles(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in split(text)]
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def test_decontamination_against_all_pairs(spark, monkeypatch):
    rows = documents()
    passage = rows[35][1]
    items = [
        (1, passage), (2, " ".join(passage.split()[:30])), (3, "ONE two three"), (4, None),
        (5, ""), (6, " ".join(passage.split()[10:40]) + " with some words that are not there"),
        (7, "a b"), (7, "c d e f g h"), (None, passage), (8, rows[45][1] or "x"), (9, "the cat the cat the"),
    ]
    merged = {}
    for item, text in items:
        merged.setdefault(item, set()).update(shingles(text))
    due = []
    for doc, text in rows:
        own = shingles(text)
        for item, wanted in merged.items():
            if wanted and item is not None and 100 * len(own & wanted) >= 75 * len(wanted):
                due.append((doc, item, len(wanted), len(own & wanted)))
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS w", "2 AS hash")
    docs = frame(spark, rows + [rows[30]])
    for constant in (decontaminate.MAX_CONSTANT, 0):
        monkeypatch.setattr(decontaminate, "MAX_CONSTANT", constant)
        found = decontaminate.contained(docs, table).where("item_id IS NOT NULL").collect()
        assert sorted(map(tuple, found)) == sorted(due)
    clean = decontaminate.without_contaminated(docs, table)
    assert clean.columns == docs.columns
    bad = {d for d, *_ in due}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(
        d for d, _ in [*rows, rows[30]] if d not in bad
    )
    assert decontaminate.contained(docs, table.where("false")).collect() == []
    assert decontaminate.contained(docs.where("false"), table).collect() == []


@pytest.mark.parametrize("constant", [decontaminate.MAX_CONSTANT, 0])
def test_ids_of_null_hold_and_are_held(spark, monkeypatch, constant):
    monkeypatch.setattr(decontaminate, "MAX_CONSTANT", constant)
    a, b, c = (" ".join(f"{x}{i}" for i in range(12)) for x in "abc")
    items = spark.createDataFrame([(1, a), (None, b), (None, c)], "item_id long, text string")
    rows = [(1, f"x {a} y"), (None, f"{a} z"), (None, "clean"), (2, f"{b} {c}"), (3, b), (4, "clean"), (None, f"{c} {b}")]
    docs = frame(spark, rows)
    found = decontaminate.contained(docs, items).collect()
    due = [(1, 1, 8, 8), (None, 1, 8, 8), (2, None, 16, 16), (None, None, 16, 16)]
    assert sorted(map(tuple, found), key=str) == sorted(due, key=str)
    clean = decontaminate.without_contaminated(docs.union(docs.where("doc_id = 4")), items)
    assert clean.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in clean.collect()]
    # Neither of the null item's texts is the whole item, so b alone stays.
    assert sorted(kept, key=str) == sorted([(None, "clean"), (3, b), (4, "clean"), (4, "clean")], key=str)


def test_a_repeated_id_goes_only_where_it_holds_an_item(spark):
    a = " ".join(f"a{i}" for i in range(12))
    items = spark.createDataFrame([(1, a)], "item_id long, text string")
    docs = frame(spark, [(1, "clean"), (1, f"{a} z"), (2, a), (3, "also clean")])
    kept = decontaminate.without_contaminated(docs, items).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, "clean"), (3, "also clean")]
