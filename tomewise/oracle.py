"""DuckDB SQL for every SQL-checkable query.

Each string is self-contained: it rebuilds the fixture views and the
preparation chain as CTEs over the pre-registered driver tables.  Random
choices use the same seeded md5 keys as the Spark side; doubles are compared
after rounding by the checker.
"""

from __future__ import annotations

from tomewise.functions.constants import (
    CLEAN_FILTER_CHARS,
    CONTRACTIONS,
    USELESS_WORDS,
    WHITESPACE_RUN,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = _q(WHITESPACE_RUN)

# --- fixture views --------------------------------------------------------

C_REVIEWS = f"""
reviews AS (
  SELECT doc_id AS review_id,
         CASE WHEN doc_id % 53 <> 52 THEN CAST(floor(sqrt(doc_id * 16.0)) AS BIGINT) END AS book_id,
         CASE WHEN n_chars % 41 <> 0 THEN concat(source, '-', CAST(n_chars % 13 AS VARCHAR)) END AS user_id,
         text AS review_text,
         CAST(CASE WHEN n_chars % 36 < 1 THEN 0 WHEN n_chars % 36 < 4 THEN 1
                   WHEN n_chars % 36 < 9 THEN 2 WHEN n_chars % 36 < 16 THEN 3
                   WHEN n_chars % 36 < 25 THEN 4 ELSE 5 END AS INTEGER) AS rating
  FROM documents)"""

C_NORMALISED = f"""
normalised AS (
  SELECT review_id, book_id, user_id,
         trim(regexp_replace(lower(review_text), {WS}, ' ', 'g')) AS review_text, rating
  FROM reviews)"""

C_DEDUP = """
deduped AS (
  SELECT review_id, book_id, user_id, review_text, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY review_text ORDER BY review_id) AS rn
    FROM normalised WHERE review_text IS NOT NULL) WHERE rn = 1)"""

C_BALANCED = """
class_n AS (SELECT rating, count(*) AS n FROM deduped WHERE rating IS NOT NULL GROUP BY rating),
balanced AS (
  SELECT review_id, book_id, user_id, review_text, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY rating
              ORDER BY md5(concat('42', ':', CAST(review_id AS VARCHAR))), review_id) AS rn
    FROM deduped WHERE rating IS NOT NULL)
  WHERE rn <= (SELECT min(n) FROM class_n))"""

C_PROCESSED = """
processed AS (
  SELECT *, CAST(length(review_text) AS INTEGER) AS full_length,
         CASE WHEN length(review_text) = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE length(replace(review_text, ' ', '')) / len(string_split(review_text, ' ')) END
           AS mean_word_length
  FROM balanced)"""

C_SPLIT = """
grp AS (SELECT DISTINCT book_id FROM processed WHERE book_id IS NOT NULL),
g1 AS (SELECT book_id, row_number() OVER (
         ORDER BY md5(concat('42', ':', CAST(book_id AS VARCHAR))), book_id) AS r1 FROM grp),
g1n AS (SELECT floor(CAST(0.8 AS DOUBLE) * count(*)) AS n1 FROM grp),
g2 AS (SELECT book_id, row_number() OVER (
         ORDER BY md5(concat('43', ':', CAST(book_id AS VARCHAR))), book_id) AS r2
       FROM g1 WHERE r1 <= (SELECT n1 FROM g1n)),
g2n AS (SELECT floor(CAST(0.75 AS DOUBLE) * (SELECT n1 FROM g1n)) AS n2),
gsplit AS (SELECT g1.book_id,
                  CASE WHEN g1.r1 > (SELECT n1 FROM g1n) THEN 'test'
                       WHEN g2.r2 <= (SELECT n2 FROM g2n) THEN 'train' ELSE 'valid' END AS split
           FROM g1 LEFT JOIN g2 USING (book_id)),
splitted AS (SELECT p.*, coalesce(s.split, 'train') AS split FROM processed p LEFT JOIN gsplit s ON p.book_id = s.book_id),
train AS (SELECT * FROM splitted WHERE split = 'train')"""

CHAIN = {
    "reviews": [C_REVIEWS],
    "normalised": [C_REVIEWS, C_NORMALISED],
    "deduped": [C_REVIEWS, C_NORMALISED, C_DEDUP],
    "processed": [C_REVIEWS, C_NORMALISED, C_DEDUP, C_BALANCED, C_PROCESSED],
    "split": [C_REVIEWS, C_NORMALISED, C_DEDUP, C_BALANCED, C_PROCESSED, C_SPLIT],
}


def with_chain(level: str, *extra: str, body: str) -> str:
    ctes = list(CHAIN[level]) + [e for e in extra]
    return "WITH " + ",".join(ctes) + "\n" + body


# --- text cleaning in SQL -------------------------------------------------

def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {WS}, ' ', 'g'))"


def sql_clean(x: str) -> str:
    """TX6..TX10 in the same order as the Spark chain."""
    y = f"regexp_replace({x}, '<[^\\n]*?>', '', 'g')"
    y = f"replace(replace({y}, '\\', ''), '\"', '')"
    y = f"regexp_replace({y}, '[^\\x00-\\x7f]', '', 'g')"
    y = f"regexp_replace({y}, 'http[^\\x09-\\x0d\\x1c-\\x20]+', '', 'g')"
    y = f"translate({y}, {_q(CLEAN_FILTER_CHARS)}, {_q(' ' * len(CLEAN_FILTER_CHARS))})"
    return sql_collapse(y)


def sql_stop_list(words=None) -> str:
    words = USELESS_WORDS if words is None else words
    return "[" + ", ".join(_q(w) for w in words) + "]"


def sql_remove_stopwords(x: str, words=None) -> str:
    return (f"array_to_string(list_filter(string_split({x}, ' '), "
            f"lambda w: NOT list_contains({sql_stop_list(words)}, w)), ' ')")


def sql_tokenize_filtered(x: str) -> str:
    y = f"regexp_replace({x}, '[0-9]+', '', 'g')"
    return sql_remove_stopwords(sql_contractions(sql_clean(y)))


def sql_contractions(x: str) -> str:
    """Replaces every leftmost match of the contractions, the first key that
    fits at its place: the text is cut at the matches and the replacements are
    put back in between."""
    keys = "|".join(CONTRACTIONS)
    cases = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in CONTRACTIONS.items())
    return (f"array_to_string(list_transform(list_zip(string_split_regex({x}, {_q(keys)}), "
            f"list_append(list_transform(regexp_extract_all({x}, {_q(keys)}), lambda k: CASE k {cases} END), '')), "
            f"lambda z: z[1] || z[2]), '')")


def sql_histogram(src: str, expr: str, lo: float, hi: float, bins: int, where: str = "TRUE") -> str:
    """Dense equal-width histogram ``bin, lo, hi, n`` (last bin closed)."""
    w = (hi - lo) / bins
    v = f"CAST({expr} AS DOUBLE)"
    return f"""
SELECT b.bin, CAST({lo!r} AS DOUBLE) + b.bin * CAST({w!r} AS DOUBLE) AS lo,
       CAST({lo!r} AS DOUBLE) + (b.bin + 1) * CAST({w!r} AS DOUBLE) AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) b
LEFT JOIN (SELECT least(CAST(floor(({v} - CAST({lo!r} AS DOUBLE)) * CAST({float(bins)!r} AS DOUBLE)
                                  / (CAST({hi!r} AS DOUBLE) - CAST({lo!r} AS DOUBLE))) AS INTEGER), {bins - 1}) AS bin,
                  count(*) AS n
           FROM {src} WHERE ({where}) AND {v} >= CAST({lo!r} AS DOUBLE) AND {v} <= CAST({hi!r} AS DOUBLE)
           GROUP BY 1) c USING (bin)"""
