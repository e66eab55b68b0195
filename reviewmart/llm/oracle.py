"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from reviewmart.llm.queries import BLOCKED_HOSTS, RULES

OP3 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))::BIGINT) e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT q.vec_id query_id, c.vec_id,
        list_sum(list_transform(range(1, len(c.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) rank FROM s
)
WHERE rank <= 10
"""

OP11 = """
WITH v AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::BIGINT) e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
    SELECT a.vec_id anchor_id, c.vec_id, a.label = c.label same,
        list_sum(list_transform(range(1, len(c.e) + 1), lambda i: a.e[i] * c.e[i]))::BIGINT score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
    SELECT anchor_id, vec_id positive_id, score positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


# Words are lower-cased (A-Z only) and lie between the six ASCII blanks.
_WORDS = r"""
SELECT {id}, list_filter(string_split(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
    'abcdefghijklmnopqrstuvwxyz     '), ' '), lambda x: x <> '') w
FROM {table}
"""
_SHINGLES = """
SELECT DISTINCT {id}, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
    WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) s
FROM {words}
"""


def _shingles(table: str, id_column: str) -> str:
    words = f"({_WORDS.format(id=id_column, table=table)})"
    return _SHINGLES.format(id=id_column, words=words)


OP5 = r"""
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') w FROM documents
),
v AS (
    SELECT doc_id, i, md5(list_aggregate(w[i:i + 34], 'string_agg', ' ')) h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) i FROM w)
),
r AS (SELECT h FROM v GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM v JOIN r USING (h), range(0, 35) t(j)),
k AS (
    SELECT x.doc_id, count(*) n, count(gone.i) g,
        string_agg(x.s, ' ' ORDER BY x.i) FILTER (gone.i IS NULL) kept
    FROM (SELECT doc_id, unnest(w) s, unnest(range(1, len(w) + 1)) i FROM w) x
    LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY x.doc_id
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(g, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE d AS MATERIALIZED ({_shingles("documents", "doc_id")}),
n AS MATERIALIZED (SELECT doc_id, count(*) n FROM d GROUP BY doc_id),
links AS MATERIALIZED (
    SELECT a.doc_id a, b.doc_id b FROM d a JOIN d b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
),
reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a
"""

OP9 = f"""
WITH i AS ({_shingles("benchmark", "item_id")}),
d AS ({_shingles("documents", "doc_id")}),
n AS (SELECT item_id, count(*) n_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) n_common
FROM i JOIN d USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING 100 * count(*) >= 75 * n_shingles
"""


def _fits(rule) -> str:
    return (
        f"((host = '{rule.host}' OR ends_with(host, '.{rule.host}'))"
        f" AND starts_with(path, '{rule.path}'))"
    )


def _op7() -> str:
    longest = sorted(RULES, key=lambda r: -len(r.name))
    names = " ".join(f"WHEN {_fits(r)} THEN '{r.name}'" for r in longest)
    verdicts = " ".join(f"WHEN {_fits(r)} THEN '{r.verdict}'" for r in longest)
    listed = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in BLOCKED_HOSTS)
    return f"""
SELECT page_id, host, path, CASE {names} ELSE NULL END AS rule,
    CASE {verdicts} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict
FROM (
    SELECT page_id,
        translate(regexp_extract(u, '://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(u, '://([^/?#]*)([^?#]*)', 2) AS path
    FROM (SELECT page_id, coalesce(url, '') u FROM pages)
)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_topk": OP3,
        "op5_substring_dedup": OP5,
        "op7_url_filter": _op7(),
        "op8_jaccard_join": OP8,
        "op9_decontaminate": OP9,
        "op11_hard_negatives": OP11,
    }
