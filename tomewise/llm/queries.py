"""One query per operator over its whole table, and DuckDB SQL where SQL can
express the result.  The operators have wider interfaces; the queries derive
digests and counts from their outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewise.llm import (bond, bpe, chat, line_windows, main_text, packing, periodic, projections, repetition, simhash,
                          token_counts, topk, warc)
from tomewise.session import reliable, remove_dir, scratch_dir

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public vocabulary files are installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as the chosen side of a pair whose rejected side has
    its replies in reverse order."""
    turns = chat.conversations_as_turns(_table(spark, sf_dir, "conversations"))
    pairs = turns.select("conv_id", F.col("turns").alias("chosen"),
                         chat.mirrored_replies(F.col("turns")).alias("rejected"))
    made = chat.format_preferences(pairs)
    return made.select(
        "conv_id", F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
        F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen_completion", 256).alias("chosen_sha256"),
        F.sha2("rejected_completion", 256).alias("rejected_sha256"),
        chat.trained_chars(F.col("chosen_mask")).alias("chosen_trained_chars"),
        chat.trained_chars(F.col("rejected_mask")).alias("rejected_trained_chars"), "usable")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op3_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), vocabulary_path(), keep=["doc_id"],
                      outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(_table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words",
        "base_failed", "kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), vocabulary_path(), keep=["doc_id"])


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives and index are written, every page is looked up in them and read
    back, and then they go; the rows read are kept by a checkpoint."""
    pages, root = _table(spark, sf_dir, "pages"), scratch_dir(spark, "warc")
    captures = warc.write_archives(pages, root)
    ranges = warc.write_index(captures, root)
    asked = pages.select(F.col("url").cast("string").alias("url"), F.col("page_id").cast("long").alias("page"))
    read = reliable(warc.look_up(asked, ranges, root, payloads=False).select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"))
    remove_dir(spark, root)
    return read


def op7_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.remove_repeated_windows(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary_path())


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised("embedding").alias("weights"))
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5, id_col="vec_id").select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector as an anchor; every seventh has another label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"),
                                                         topk.quantised("embedding").alias("weights"))
    return bond.hard_negatives(vectors.where(F.col("vec_id") % 100 == 0), vectors, id_col="vec_id")


def with_loops(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in the documents whose id has a checksum divisible by
    ten, the words from a place on are the first few of them over and over."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return (docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
            .withColumn("w", F.when(F.col("h") % 10 == 0, words))
            .selectExpr("doc_id", "text", "w", "h div 10 as g", "size(w) as n")
            .selectExpr("*", "if(n > 0, int(g % n), 0) as a")
            .selectExpr("*", "int(1 + (n - a) div (3 + g % 8)) as p")
            .selectExpr("doc_id", """if(n > 0, array_join(concat(slice(w, 1, a), slice(flatten(
                array_repeat(slice(w, a + 1, p), int((n - a) div p) + 1)), 1, n - a)), ' '), text) as text"""))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_loops(_table(spark, sf_dir, "documents")), keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


def op13_collision_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_duplicates(_table(spark, sf_dir, "embeddings"), id_col="vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_preference_format, op2_main_text, op3_bpe_roundtrip, op4_repetition_rules, op5_token_counts, op6_warc_index,
    op7_line_windows, op8_sum_of_squares_packing, op9_exact_top_k, op10_simhash_components, op11_bond_negatives,
    op12_periodic_runs, op13_collision_projections)}

# Stated from the definitions, not from the Spark code: replies are numbered
# and paired with the reply numbered from the other end; the prefix ends before
# the first turn whose two texts differ; the longer side's rest is rendered.
_OP1 = r"""
WITH turns AS (
  SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS own FROM (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)),
placed AS (
  SELECT *, row_number() OVER w AS i, lag(text) OVER w AS before,
         row_number() OVER (PARTITION BY conv_id, own, role = 'assistant' ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id, own, role = 'assistant') AS m
  FROM turns WINDOW w AS (PARTITION BY conv_id, own ORDER BY turn NULLS FIRST, role, text)),
sides AS (
  SELECT a.conv_id, a.own, a.i, a.role, a.text AS chosen,
         CASE WHEN a.role <> 'assistant' THEN a.text
              WHEN 2 * a.k = a.m + 1 THEN coalesce(a.before, '')
              ELSE b.text END AS rejected
  FROM placed a LEFT JOIN placed b
    ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.own = a.own AND b.role = 'assistant' AND a.role = 'assistant' AND b.k = a.m + 1 - a.k),
cut AS (
  SELECT *, coalesce(min(CASE WHEN chosen <> rejected THEN i END) OVER (PARTITION BY conv_id, own),
                     max(i) OVER (PARTITION BY conv_id, own) + 1) AS d
  FROM sides),
shown AS (
  SELECT *, '<|' || role || '|>' || chr(10) || chosen || '<|end|>' || chr(10) AS c,
            '<|' || role || '|>' || chr(10) || rejected || '<|end|>' || chr(10) AS r
  FROM cut)
SELECT conv_id, (max(d) - 1)::BIGINT AS n_prompt_turns,
  sha256(coalesce(string_agg(c, '' ORDER BY i) FILTER (WHERE i < d), '')) AS prompt_sha256,
  sha256(coalesce(string_agg(c, '' ORDER BY i) FILTER (WHERE i >= d), '')) AS chosen_sha256,
  sha256(coalesce(string_agg(r, '' ORDER BY i) FILTER (WHERE i >= d), '')) AS rejected_sha256,
  coalesce(sum(length(chosen) + 8) FILTER (WHERE i >= d AND role = 'assistant'), 0)::BIGINT AS chosen_trained_chars,
  coalesce(sum(length(rejected) + 8) FILTER (WHERE i >= d AND role = 'assistant'), 0)::BIGINT AS rejected_trained_chars,
  coalesce(bool_or(role = 'assistant') FILTER (WHERE i >= d), false) AS usable
FROM shown GROUP BY conv_id, own"""

# Repeats of at least L words cover what repeated L-word windows cover; a repeat
# of more than n words exists if some window of n + 1 words is found twice.
_OP4 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT *, len(w) AS n_words, greatest({repetition.MAX_REPEAT_WORDS}, len(w) * {repetition.MAX_REPEAT_PERCENT} // 100) + 1 AS far FROM d),
sizes AS (SELECT r, w, n_words, unnest([{repetition.WINDOW_WORDS}, {repetition.MIN_REPEAT_WORDS}, far]) AS size FROM n),
places AS (SELECT r, size, w, unnest(generate_series(1, n_words - size + 1)) AS i FROM sizes WHERE n_words >= size),
grams AS (SELECT r, size, i, md5(array_to_string(w[i:i + size - 1], ' ')) AS g FROM places),
twice AS (SELECT r, size, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, size, g) > 1),
spans AS (
  SELECT r, size, i, least(size, coalesce(lead(i) OVER (PARTITION BY r, size ORDER BY i) - i, size)) AS own FROM twice),
covered AS (
  SELECT r, coalesce(sum(own) FILTER (WHERE size = {repetition.WINDOW_WORDS}), 0) AS win,
         coalesce(sum(own) FILTER (WHERE size = {repetition.MIN_REPEAT_WORDS}), 0) AS cov,
         coalesce(max(size), 0) AS longest
  FROM spans GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
worded AS (SELECT r, line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
equal AS (SELECT r, count(*) - count(DISTINCT line) AS dup FROM worded GROUP BY r),
facts AS (
  SELECT n.doc_id, n.n_words, n.far,
    length(n.text) - length(regexp_replace(n.text, '[^\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(n.text) - length(regexp_replace(n.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup, 0) AS n_dup_lines, coalesce(win, 0) AS n_repeat_words, coalesce(cov, 0) AS n_covered_words,
    coalesce(longest, 0) AS longest
  FROM n LEFT JOIN covered USING (r) LEFT JOIN equal USING (r)),
judged AS (
  SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MAX_WINDOW_PERCENT} * n_words AS base_failed FROM facts)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_covered_words::BIGINT AS n_covered_words,
  base_failed,
  NOT base_failed AND 100 * n_covered_words <= {repetition.MAX_COVERED_PERCENT} * n_words AND longest < far AS kept
FROM judged"""

_OP6 = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
t AS (SELECT *, payload_bytes >= {warc.REVISIT_BYTES} AND page_id > first AS again FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to FROM t"""

_W = line_windows.WINDOW_LINES
_OP7 = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
places AS (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM d),
lines AS (SELECT doc_id, i, ls[i] AS line, trim(ls[i], ' ') AS bare FROM places),
wins AS (
  SELECT doc_id, i, {", ".join(f"lead(bare, {k}) OVER w AS b{k}" for k in range(_W))},
         count(*) OVER (PARTITION BY doc_id) AS n FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
whole AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY {", ".join(f"b{k}" for k in range(_W))} ORDER BY doc_id, i) AS nth
  FROM wins WHERE i + {_W - 1} <= n AND regexp_matches({" || ".join(f"b{k}" for k in range(_W))}, '[^\\s\\x0B]')),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {_W - 1})) AS i FROM whole WHERE nth > 1),
left_over AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS kept
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       length(kept)::BIGINT AS n_chars, sha256(kept) AS text_sha256
FROM d LEFT JOIN left_over USING (doc_id)"""

_OP9 = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

_OP11 = """
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10"""

# All pairs of a label; the search finds a stated share of those at the bound.
_OP13 = f"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings),
e AS (
  SELECT r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM rows
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b, b.vec_id FROM e a JOIN e b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {projections.MIN_COSINE}),
reach AS (
  SELECT r AS a, r AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY a),
degree AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id IS NOT DISTINCT FROM coalesce(component_id, vec_id) AS kept
FROM rows LEFT JOIN least USING (r) LEFT JOIN degree USING (r)"""

ORACLE: dict[str, str] = {
    "op1_preference_format": _OP1, "op4_repetition_rules": _OP4, "op6_warc_index": _OP6, "op7_line_windows": _OP7,
    "op9_exact_top_k": _OP9, "op11_bond_negatives": _OP11,
    "op13_collision_projections": _OP13}
