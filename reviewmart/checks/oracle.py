"""The queries in plain SQL, over the same given tables."""

from __future__ import annotations

from reviewmart.functions.stopwords import ENGLISH

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
_SPACE = r"[ \t\n\x0b\f\r]"

_PURCHASES = """
purchases AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS invoice_number,
         CAST(l_partkey AS VARCHAR) AS stock_code,
         l_returnflag || ' ' || l_linestatus AS detail,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(o_orderdate AS TIMESTAMP) AS invoice_date,
         CAST(CAST(l_extendedprice AS DECIMAL(10, 2)) * CAST(0.1 AS DECIMAL(2, 1))
              AS DECIMAL(8, 3)) AS unit_price,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
              THEN CAST(o_custkey AS INTEGER) END AS customer_id,
         o_orderstatus AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_REVIEWS = """
reviews AS (
  SELECT CASE WHEN lang <> 'es' THEN CAST(doc_id // 3 * 5 AS INTEGER) END AS cid,
         text AS review_str, doc_id * 20 AS id_review
  FROM documents
), more_reviews AS (
  SELECT CASE WHEN role <> 'system' THEN CAST(conv_id // 3 * 5 AS INTEGER) END AS cid,
         text AS review_str, conv_id * 20 AS id_review
  FROM conversations
)"""

_LOGS = """
logs AS (
  SELECT o_orderpriority AS device,
         '10.0.0.' || o_custkey AS ipAddress,
         'store <' || o_custkey || '> & co' AS location,
         strftime(o_orderdate, '%m-%d-%Y') AS logDate,
         CASE WHEN o_orderstatus = 'P' THEN o_orderpriority || ' P'
              ELSE o_orderpriority END AS os,
         CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS phoneNumber,
         o_orderkey AS id_review
  FROM orders
), agents AS (
  SELECT *, string_split(os, ' ') AS words FROM logs
), enriched AS (
  SELECT id_review, device, ipAddress, location, logDate,
         CASE WHEN len(words) = 2 THEN words[2] ELSE words[1] END AS os,
         phoneNumber,
         CASE WHEN len(words) = 2 THEN words[1] END AS browser
  FROM agents
), dated AS (
  SELECT id_review, CAST(try_strptime(logDate, '%m-%d-%Y') AS DATE) AS log_date
  FROM logs
)"""


def _words(source: str) -> str:
    """Tokens of the texts in ``source``; empty ones at the end do not count."""
    return rf"""
cut AS (
  SELECT *, regexp_replace(lower(review_str), '{_SPACE}+$', '') AS body FROM {source}
), words AS (
  SELECT *, CASE WHEN body = '' AND review_str <> '' THEN []
                 ELSE string_split_regex(body, '{_SPACE}') END AS tok
  FROM cut
), kept AS (
  SELECT *, list_filter(tok, lambda t: t NOT IN ({_STOP})) AS tok_sw FROM words
)"""


def _staged(source: str, keyword: str) -> str:
    """Tokenise, drop stop words, join by commas, look for the keyword."""
    return f"""{_words(source)}, staged AS (
  SELECT cid AS user_id,
         CASE WHEN contains(array_to_string(tok_sw, ','), '{keyword}')
              THEN 1 ELSE 0 END AS positive_review,
         id_review AS review_id
  FROM kept
)"""


_BOTH = """
both_reviews AS (
  SELECT * FROM reviews UNION ALL SELECT * FROM more_reviews
)"""

_MOVIES = f"""{_REVIEWS}, {_BOTH}, {_staged("both_reviews", "the")}, movies AS (
  SELECT DISTINCT * FROM staged
)"""

_SPEND = """
spend AS (
  SELECT customer_id, CAST(sum(quantity * unit_price) AS DECIMAL(29, 3)) AS amount_spent
  FROM purchases WHERE customer_id IS NOT NULL GROUP BY customer_id
)"""

_SCORE = """
score AS (
  SELECT user_id, CAST(sum(positive_review) AS BIGINT) AS review_score,
         count(user_id) AS review_count
  FROM movies GROUP BY user_id
)"""

_USERS = f"""{_PURCHASES}, {_MOVIES}, {_SPEND}, {_SCORE}, users AS (
  SELECT customer_id, amount_spent, review_count, review_score
  FROM spend FULL JOIN score ON customer_id = user_id
  WHERE customer_id IS NOT NULL
)"""

_FACT = f"""WITH {_USERS}, {_LOGS}
SELECT review_id, user_id, logDate, device, location, os, browser,
       amount_spent, review_count, review_score
FROM movies
LEFT JOIN enriched ON review_id = id_review
LEFT JOIN users ON user_id = customer_id"""

# Month and season.
_SEASONS = """
seasons(m, season) AS (VALUES
  (1, 'winter'), (2, 'winter'), (3, 'spring'), (4, 'spring'), (5, 'spring'),
  (6, 'summer'), (7, 'summer'), (8, 'summer'), (9, 'autumn'), (10, 'autumn'),
  (11, 'autumn'), (12, 'winter')
)"""

_DIM_DATE = f"""WITH {_LOGS}, {_SEASONS}
SELECT id_review AS id_dim_date, log_date,
       CAST(day(log_date) AS VARCHAR) AS day,
       CAST(month(log_date) AS VARCHAR) AS month,
       CAST(year(log_date) AS VARCHAR) AS year,
       season
FROM dated LEFT JOIN seasons ON m = month(log_date)"""


def _dim(name: str, key: str) -> str:
    return f"WITH {_LOGS} SELECT id_review AS {key}, {name} FROM enriched"


def _users(insert_date: bool) -> str:
    stamp = ", TIMESTAMP '2024-01-01 00:00:00' AS insert_date" if insert_date else ""
    return f"WITH {_USERS} SELECT *{stamp} FROM users"


_LOG_COLUMNS = "device, ipAddress, location, logDate, os, phoneNumber"

# The files hold the logs in id order.
_NUMBERED = f"""WITH {_LOGS}
SELECT {_LOG_COLUMNS}, row_number() OVER (ORDER BY id_review) AS id_review FROM logs"""

# One id in five has an empty record between two of its own, one has one before its own.
_ODD = f"""WITH {_LOGS}, odd AS (
  SELECT o.* EXCLUDE (id_review), id_review AS id, place,
         (id_review % 5 = 2 AND place = 1) OR (id_review % 5 = 3 AND place = 0) AS empty
  FROM logs o, range(0, 3) t(place)
  WHERE place < CASE id_review % 5 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END
)
SELECT {", ".join(f"CASE WHEN NOT empty THEN {c} END AS {c}" for c in _LOG_COLUMNS.split(", "))},
       row_number() OVER (ORDER BY id, place) AS id_review FROM odd"""

_FACT_NUMBERED = _FACT.replace(
    "o_orderkey AS id_review", "row_number() OVER (ORDER BY o_orderkey) AS id_review"
)


def oracle_sql() -> dict[str, str]:
    return {
        # sources, landing, export
        "load_purchases": f"WITH {_PURCHASES} SELECT * FROM purchases",
        "purchases_row_count": f"""WITH {_PURCHASES}
            SELECT count(*) AS total_rows FROM purchases""",
        "export_purchases": f"WITH {_PURCHASES} SELECT * FROM purchases",
        "read_reviews_csv": f"WITH {_REVIEWS} SELECT * FROM reviews",
        "review_value_counts": f"""WITH {_REVIEWS}
            SELECT count(*) AS rows,
                count(*) FILTER (id_review % 11 = 0 OR (id_review % 7 = 0 AND cid IS NOT NULL)) AS odd_rows,
                count(*) FILTER (id_review % 7 = 0 AND cid IS NOT NULL) AS nulled_cid,
                count(*) FILTER (id_review % 11 = 0) AS nulled_id_review
            FROM reviews""",
        # reviews
        "review_tokens": f"""WITH {_REVIEWS}, {_words("reviews")}
            SELECT id_review, len(tok) AS n_tokens, len(tok_sw) AS n_kept FROM kept""",
        "stage_reviews": f"""WITH {_REVIEWS}, {_staged("reviews", "tion")}
            SELECT * FROM staged""",
        "stage_reviews_stopword": f"""WITH {_REVIEWS}, {_staged("reviews", "the")}
            SELECT * FROM staged""",
        "stage_reviews_span": f"""WITH {_REVIEWS}, {_staged("reviews", "tion,the")}
            SELECT * FROM staged""",
        "reviews_preview": f"""WITH {_REVIEWS}, {_staged("reviews", "tion")}
            SELECT * FROM staged ORDER BY review_id, user_id, positive_review LIMIT 10""",
        "reviews_union": f"WITH {_MOVIES} SELECT * FROM movies",
        # logs
        "stage_logs_csv": f"WITH {_LOGS} SELECT {_LOG_COLUMNS}, id_review FROM logs",
        "stage_logs_text": _NUMBERED,
        "stage_logs_text_spread": _NUMBERED,
        "stage_logs_text_odd": _ODD,
        "stage_logs_xml": _NUMBERED,
        "split_os_browser": f"WITH {_LOGS} SELECT * FROM enriched",
        # dimensions
        "dim_date": _DIM_DATE,
        "dim_devices": _dim("device", "id_dim_devices"),
        "dim_location": _dim("location", "id_dim_location"),
        "dim_os": _dim("os", "id_dim_os"),
        "dim_browser": _dim("browser", "id_dim_browser"),
        "dim_date_table": _DIM_DATE,
        "season_counts_sql": f"""WITH dim_date AS ({_DIM_DATE})
            SELECT season, count(*) AS n_logs FROM dim_date GROUP BY season""",
        # facts
        "spend_per_customer": f"WITH {_PURCHASES}, {_SPEND} SELECT * FROM spend",
        "score_per_user": f"WITH {_MOVIES}, {_SCORE} SELECT * FROM score",
        "user_behavior": _users(insert_date=False),
        "fct_users": _users(insert_date=True),
        "reviews_with_logs": f"""WITH {_MOVIES}, {_LOGS}
            SELECT review_id, user_id, positive_review,
                   logDate, device, location, os, browser
            FROM movies LEFT JOIN enriched ON review_id = id_review""",
        "reviews_with_repeated_logs": f"""WITH {_MOVIES}, {_LOGS}, repeated AS (
              SELECT o_custkey * 20 AS log_id, enriched.*
              FROM enriched JOIN orders ON o_orderkey = id_review
            )
            SELECT review_id, user_id, positive_review,
                   logDate, device, location, os, browser
            FROM movies LEFT JOIN repeated ON review_id = log_id""",
        "fct_movie_analytics": _FACT,
        "fct_movie_analytics_hot_keys": _FACT,
        "mart_from_files": _FACT,
        "mart_from_text_logs": _FACT_NUMBERED,
        "mart_line_breaks": _users(insert_date=False),
    }
