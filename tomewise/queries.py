"""Registered queries: one per operator of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables; its
DuckDB twin (when the semantics are SQL-expressible) is registered with it.
Column names and types agree on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise import fixtures
from tomewise import oracle as O
from tomewise.functions import text as tx
from tomewise.operators import eda
from tomewise.operators.sampling import seeded_head, seeded_permutation
from tomewise.plans import prepare as P
from tomewise.session import reliable, remove_dir, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- Step 1: minimum slice, text features, frequencies ----------------------

@query("rating_counts", O.with_chain("reviews", body="""
SELECT rating, count(*) AS count FROM reviews WHERE rating IS NOT NULL GROUP BY rating"""))
def q_rating_counts(spark, sf):
    """AG1 on the raw corpus."""
    return eda.value_counts(fixtures.reviews(spark, sf), "rating")


@query("user_counts", O.with_chain("processed", body="""
SELECT user_id, count(*) AS count FROM processed WHERE user_id IS NOT NULL GROUP BY user_id"""))
def q_user_counts(spark, sf):
    """AG1 on the processed corpus."""
    return eda.value_counts(P.processed(spark, sf), "user_id")


@query("corpus_shape", O.with_chain("processed", body="""
SELECT 'raw' AS stage, count(*) AS n_rows, count(DISTINCT book_id) AS n_books,
       count(DISTINCT user_id) AS n_users FROM reviews
UNION ALL
SELECT 'deduped', count(*), count(DISTINCT book_id), count(DISTINCT user_id) FROM deduped
UNION ALL
SELECT 'balanced', count(*), count(DISTINCT book_id), count(DISTINCT user_id) FROM processed"""))
def q_corpus_shape(spark, sf):
    """AG2 + AG3 before and after dedup and balancing."""
    parts = [("raw", fixtures.reviews(spark, sf)), ("deduped", P.deduped(spark, sf)),
             ("balanced", P.processed(spark, sf))]
    out = None
    for stage, df in parts:
        s = eda.shape(df).select(F.lit(stage).alias("stage"), "n_rows", "n_books", "n_users")
        out = s if out is None else out.unionByName(s)
    return out


@query("common_reviews", O.with_chain("normalised", body="""
SELECT review_text, count(*) AS Frequency FROM normalised WHERE review_text IS NOT NULL
GROUP BY review_text ORDER BY Frequency DESC, review_text LIMIT 100"""))
def q_common_reviews(spark, sf):
    """SL1: the 100 most common normalised texts."""
    return eda.most_common(P.normalised(spark, sf, drop_null=True), "review_text", 100, "Frequency")


@query("normalised_text", O.with_chain("normalised", body="""
SELECT review_id, review_text FROM normalised"""))
def q_normalised_text(spark, sf):
    """TX1 + TX2 over every review."""
    return P.normalised(spark, sf).select("review_id", "review_text")


@query("dedup_reviews", O.with_chain("deduped", body="""
SELECT review_id, book_id, user_id, review_text, rating FROM deduped"""))
def q_dedup_reviews(spark, sf):
    """SO1: keep the first row of every normalised text."""
    return P.build_deduped(spark, sf).select("review_id", "book_id", "user_id", "review_text", "rating")


@query("text_features", O.with_chain("deduped", body="""
SELECT review_id, CAST(length(review_text) AS INTEGER) AS full_length,
       round(CASE WHEN length(review_text) = 0 THEN CAST('NaN' AS DOUBLE)
             ELSE length(replace(review_text, ' ', '')) / len(string_split(review_text, ' ')) END, 6)
         AS mean_word_length
FROM deduped"""))
def q_text_features(spark, sf):
    """TX3 + TX4 on the deduplicated corpus."""
    d = P.add_text_features(P.deduped(spark, sf))
    return d.select("review_id", "full_length", F.round("mean_word_length", 6).alias("mean_word_length"))


@query("rating_hist", O.with_chain("reviews", body=O.sql_histogram("reviews", "rating", -0.5, 5.5, 6)))
def q_rating_hist(spark, sf):
    """AG4: integer-centred bins -0.5..5.5 on the raw ratings."""
    return eda.histogram(fixtures.reviews(spark, sf), "rating", -0.5, 5.5, 6)


@query("undersample", O.with_chain("processed", body="""
SELECT review_id, book_id, user_id, rating FROM processed"""))
def q_undersample(spark, sf):
    """SP1: every class cut to the minority size by the seeded key."""
    return P.build_processed(spark, sf).select("review_id", "book_id", "user_id", "rating")


@query("balanced_rating_hist", O.with_chain("processed", body=O.sql_histogram("processed", "rating", -0.5, 5.5, 6)))
def q_balanced_rating_hist(spark, sf):
    """AG4 after balancing: every class the same height."""
    return eda.histogram(P.processed(spark, sf), "rating", -0.5, 5.5, 6)


@query("seeded_shuffle_head", O.with_chain("processed", body="""
SELECT review_id, rating, CAST(row_number() OVER (
         ORDER BY md5(concat('7', ':', CAST(review_id AS VARCHAR))), review_id) AS INTEGER) AS position
FROM processed
ORDER BY md5(concat('7', ':', CAST(review_id AS VARCHAR))), review_id LIMIT 20"""))
def q_seeded_shuffle_head(spark, sf):
    """SL4: head of a repeatable permutation of the processed corpus."""
    return seeded_head(P.processed(spark, sf).select("review_id", "rating"), 20, seed=7)


@query("seeded_shuffle", O.with_chain("processed", body="""
SELECT review_id, rating, CAST(row_number() OVER (
         ORDER BY md5(concat('7', ':', CAST(review_id AS VARCHAR))), review_id) AS BIGINT) AS position
FROM processed"""))
def q_seeded_shuffle(spark, sf):
    """SL4: the whole processed corpus with its place in the seeded permutation."""
    return seeded_permutation(P.processed(spark, sf).select("review_id", "rating"), seed=7)


# --- Step 2/3: joins, splits, EDA on the train split ------------------------

from tomewise.operators import splits as S  # noqa: E402

_SPLIT_ROWS = "SELECT review_id, book_id, split FROM splitted"


@query("group_split_exact", O.with_chain("split", body=_SPLIT_ROWS))
def q_group_split_exact(spark, sf):
    """SP2 exact: floor(0.8 G) then floor(0.75 G1) groups by seeded rank."""
    return S.group_split_exact(P.processed(spark, sf)).select("review_id", "book_id", "split")


@query("group_split_hash", O.with_chain("processed", body="""
SELECT review_id, book_id,
       CASE WHEN book_id IS NULL THEN 'train'
            WHEN substr(md5(concat('42', ':', CAST(book_id AS VARCHAR))), 1, 8) >= 'cccccccc' THEN 'test'
            WHEN substr(md5(concat('43', ':', CAST(book_id AS VARCHAR))), 1, 8) >= 'c0000000' THEN 'valid'
            ELSE 'train' END AS split
FROM processed"""))
def q_group_split_hash(spark, sf):
    """SP2 hash mode: the split is a function of the group key alone."""
    return S.group_split_hash(P.processed(spark, sf)).select("review_id", "book_id", "split")


@query("split_leakage_check", O.with_chain("split", body="""
SELECT book_id, count(DISTINCT split) AS n_splits FROM splitted WHERE book_id IS NOT NULL GROUP BY book_id
HAVING count(DISTINCT split) > 1"""))
def q_split_leakage_check(spark, sf):
    """SO3: books in more than one split (none)."""
    return S.split_leakage(P.split_processed(spark, sf))


@query("split_proportions", O.with_chain("split", body="""
SELECT split, n_rows, n_groups, n_rows / sum(n_rows) OVER () AS row_share,
       n_groups / sum(n_groups) OVER () AS group_share
FROM (SELECT split, count(*) AS n_rows, count(DISTINCT book_id) AS n_groups
      FROM splitted GROUP BY split)"""))
def q_split_proportions(spark, sf):
    """AG10: row and group shares of each split."""
    return S.split_proportions(P.split_processed(spark, sf))


@query("split_class_mix", O.with_chain("split", body="""
SELECT split, rating, n_rows, n_rows / sum(n_rows) OVER (PARTITION BY split) AS share
FROM (SELECT split, rating, count(*) AS n_rows FROM splitted GROUP BY split, rating)"""))
def q_split_class_mix(spark, sf):
    """SP5: class mix per split."""
    return S.split_class_mix(P.split_processed(spark, sf), "rating")


C_USER_N = """
user_n AS (SELECT user_id, count(*) AS n FROM reviews WHERE user_id IS NOT NULL GROUP BY user_id)"""


@query("user_activity_split", O.with_chain("reviews", C_USER_N, body="""
SELECT user_id, n, CASE WHEN n >= 5 THEN 'active' ELSE 'casual' END AS tier FROM user_n"""))
def q_user_activity_split(spark, sf):
    """PF6: users by review count, split at 5 (HAVING)."""
    n = eda.value_counts(fixtures.reviews(spark, sf), "user_id", "n")
    return n.withColumn("tier", F.when(F.col("n") >= 5, "active").otherwise("casual"))


@query("active_user_reviews", O.with_chain("reviews", C_USER_N, body="""
SELECT review_id, user_id, rating FROM reviews
WHERE user_id IN (SELECT user_id FROM user_n WHERE n >= 5)"""))
def q_active_user_reviews(spark, sf):
    """J1: reviews of users with at least 5 reviews (left-semi)."""
    return S.restrict_to_active(fixtures.reviews(spark, sf)).select("review_id", "user_id", "rating")


@query("casual_user_reviews", O.with_chain("reviews", C_USER_N, body="""
SELECT review_id, user_id, rating FROM reviews
WHERE user_id IN (SELECT user_id FROM user_n WHERE n < 5)"""))
def q_casual_user_reviews(spark, sf):
    """J2: reviews of the other users (left-anti)."""
    return S.restrict_to_casual(fixtures.reviews(spark, sf)).select("review_id", "user_id", "rating")


@query("active_user_rating_counts", O.with_chain("reviews", C_USER_N, body="""
SELECT rating, count(*) AS count FROM reviews
WHERE user_id IN (SELECT user_id FROM user_n WHERE n >= 5) AND rating IS NOT NULL GROUP BY rating"""))
def q_active_user_rating_counts(spark, sf):
    """AG1 over the active users' reviews."""
    return eda.value_counts(S.restrict_to_active(fixtures.reviews(spark, sf)), "rating")


@query("reviews_per_book_hist", O.with_chain(
    "split", "book_n AS (SELECT book_id, count(*) AS n FROM train WHERE book_id IS NOT NULL GROUP BY book_id)",
    body=O.sql_histogram("book_n", "n", 0.0, 40.0, 20)))
def q_reviews_per_book_hist(spark, sf):
    """AG5: 20 bins on [0, 40] of reviews per book (train split)."""
    per_book = eda.value_counts(P.train_rows(spark, sf), "book_id", "n")
    return eda.histogram(per_book, "n", 0.0, 40.0, 20)


_UC = "uc AS (SELECT user_id, count(*) AS n FROM processed WHERE user_id IS NOT NULL GROUP BY user_id)"


@query("user_activity_hist", O.with_chain("processed", _UC, """
rng AS (SELECT CASE WHEN min(n) = max(n) THEN CAST(min(n) AS DOUBLE) - 0.5 ELSE CAST(min(n) AS DOUBLE) END AS lo_,
               CASE WHEN min(n) = max(n) THEN CAST(max(n) AS DOUBLE) + 0.5 ELSE CAST(max(n) AS DOUBLE) END AS hi_
        FROM uc)""", body="""
SELECT b.bin, (SELECT lo_ FROM rng) + b.bin * (((SELECT hi_ FROM rng) - (SELECT lo_ FROM rng)) / 50.0) AS lo,
       (SELECT lo_ FROM rng) + (b.bin + 1) * (((SELECT hi_ FROM rng) - (SELECT lo_ FROM rng)) / 50.0) AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) b
LEFT JOIN (SELECT least(CAST(floor((CAST(n AS DOUBLE) - (SELECT lo_ FROM rng)) * 50.0
                                   / ((SELECT hi_ FROM rng) - (SELECT lo_ FROM rng))) AS INTEGER), 49) AS bin,
                  count(*) AS n
           FROM uc GROUP BY 1) c USING (bin)"""))
def q_user_activity_hist(spark, sf):
    """AG6: 50 equal bins over the range of reviews per user."""
    return eda.histogram_over_range(eda.counts_table(P.processed(spark, sf), "user_id", "n"), "n", 50)


@query("user_activity_describe", O.with_chain("processed", _UC, body="""
SELECT count(n) AS count, avg(n) AS mean, stddev_samp(n) AS std, CAST(min(n) AS DOUBLE) AS min,
       CAST(quantile_cont(n, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS q50,
       CAST(quantile_cont(n, 0.75) AS DOUBLE) AS q75, CAST(max(n) AS DOUBLE) AS max FROM uc"""))
def q_user_activity_describe(spark, sf):
    """AG7: summary of reviews per user."""
    return eda.describe(eda.counts_table(P.processed(spark, sf), "user_id", "n"), "n")


@query("length_freq_by_rating", O.with_chain("split", body="""
SELECT rating, full_length, count(*) AS n FROM train GROUP BY rating, full_length"""))
def q_length_freq_by_rating(spark, sf):
    """AG8: per rating, frequency of each review length (train)."""
    return eda.value_freq_by_group(P.train_rows(spark, sf), "rating", "full_length")


def _sql_boxplot(src: str, g: str, v: str) -> str:
    return f"""
vals AS (SELECT {g} AS g, CAST({v} AS DOUBLE) AS v FROM {src}
         WHERE {v} IS NOT NULL AND NOT isnan(CAST({v} AS DOUBLE))),
st AS (SELECT g, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
              quantile_cont(v, 0.75) AS q3 FROM vals GROUP BY g),
fz AS (SELECT g, q1, q3, q3 + 1.5 * (q3 - q1) AS hi_, q1 - 1.5 * (q3 - q1) AS lo_ FROM st),
wk AS (SELECT vals.g,
              max(CASE WHEN v <= hi_ THEN v END) AS mx, min(CASE WHEN v >= lo_ THEN v END) AS mn,
              any_value(fz.q1) AS q1, any_value(fz.q3) AS q3
       FROM vals JOIN fz USING (g) GROUP BY vals.g),
wk2 AS (SELECT g, CASE WHEN mn IS NULL OR mn > q1 THEN q1 ELSE mn END AS whisker_lo,
                  CASE WHEN mx IS NULL OR mx < q3 THEN q3 ELSE mx END AS whisker_hi FROM wk),
ol AS (SELECT vals.g, count(*) FILTER (WHERE v < whisker_lo OR v > whisker_hi) AS n_outliers
       FROM vals JOIN wk2 USING (g) GROUP BY vals.g)"""


@query("length_boxplot_by_rating", O.with_chain("split", _sql_boxplot("train", "rating", "full_length"), body="""
SELECT st.g AS rating, st.n, st.q1, st.median, st.q3, wk2.whisker_lo, wk2.whisker_hi, ol.n_outliers
FROM st JOIN wk2 USING (g) JOIN ol USING (g)"""))
def q_length_boxplot_by_rating(spark, sf):
    """AG9: box-plot figures of review length per rating (train)."""
    return eda.boxplot_stats(P.train_rows(spark, sf), "rating", "full_length")


def _sql_spearman(src: str, cols: list[str]) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            if a == b:
                parts.append(f"SELECT '{a}' AS var_a, '{a}' AS var_b, CASE WHEN count(DISTINCT {a}) > 1 "
                             f"THEN 1.0::DOUBLE ELSE 'NaN'::DOUBLE END AS rho FROM {src}")
                continue
            ranked = f"""(SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
                        rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
                 FROM (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM {src}
                       WHERE {a} IS NOT NULL AND {b} IS NOT NULL
                         AND NOT isnan(CAST({a} AS DOUBLE)) AND NOT isnan(CAST({b} AS DOUBLE))))"""
            rho = ("CASE WHEN count(DISTINCT rx) > 1 AND count(DISTINCT ry) > 1 THEN corr(rx, ry) "
                   "ELSE 'NaN'::DOUBLE END")
            parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {rho} AS rho FROM {ranked}")
            parts.append(f"SELECT '{b}' AS var_a, '{a}' AS var_b, {rho} AS rho FROM {ranked}")
    return "\nUNION ALL\n".join(parts)


_SPEARMAN_COLS = ["rating", "full_length", "mean_word_length", "one"]


@query("spearman_matrix", O.with_chain("split", "train1 AS (SELECT *, 1 AS one FROM train)",
                                       body=_sql_spearman("train1", _SPEARMAN_COLS)))
def q_spearman_matrix(spark, sf):
    """AG11: Spearman matrix of rating, length, mean word length and a column
    that does not vary (train)."""
    return eda.spearman_matrix(P.train_rows(spark, sf).withColumn("one", F.lit(1)), _SPEARMAN_COLS)


@query("phrase_filter_hist", O.with_chain("split", body=O.sql_histogram(
    "train", "rating", -0.5, 5.5, 6, where="contains(review_text, ' the ')")))
def q_phrase_filter_hist(spark, sf):
    """PF4 + AG4: rating histogram of reviews containing a phrase (train)."""
    return eda.histogram(eda.with_phrase(P.train_rows(spark, sf), " the "), "rating", -0.5, 5.5, 6)


def _sql_deal(src: str, k: int, seed: int, name: str) -> str:
    return f"""
{name}_m AS (SELECT book_id, user_id, count(*) AS m FROM {src} WHERE book_id IS NOT NULL GROUP BY book_id, user_id),
{name}_s AS (SELECT book_id, user_id AS stratum FROM (
    SELECT book_id, user_id, row_number() OVER (PARTITION BY book_id ORDER BY m DESC, user_id NULLS FIRST) AS rn
    FROM {name}_m) WHERE rn = 1),
{name}_n AS (SELECT book_id, CAST(sum(m) AS BIGINT) AS n_rows FROM {name}_m GROUP BY book_id),
{name} AS (SELECT book_id, stratum, n_rows,
    CAST((row_number() OVER (PARTITION BY stratum ORDER BY n_rows DESC,
            md5(concat('{seed}', ':', CAST(book_id AS VARCHAR))), book_id) - 1
          + CAST(('0x' || substr(md5(concat('{seed}', ':', coalesce(stratum, ''))), 1, 8)) AS BIGINT)) % {k} AS INTEGER) AS fold
  FROM {name}_n JOIN {name}_s USING (book_id))"""


@query("stratified_deal_folds", O.with_chain("processed", _sql_deal("processed", 5, 42, "d5"), body="""
SELECT book_id, stratum, n_rows, fold FROM d5"""))
def q_stratified_deal_folds(spark, sf):
    """SP3 dealt: the fold of every book over 5 folds, strata = main user."""
    return S.deal_groups(P.processed(spark, sf), 5, "book_id", "user_id", 42)


_DEALT_SPLIT = [
    _sql_deal("processed", 5, 42, "d5"),
    "rest AS (SELECT * FROM processed WHERE book_id IN (SELECT book_id FROM d5 WHERE fold <> 0))",
    _sql_deal("rest", 4, 43, "d4"),
    """dsplit AS (SELECT p.*, CASE WHEN d5.fold = 0 THEN 'test' WHEN d4.fold = 0 THEN 'valid' ELSE 'train' END AS split
       FROM processed p LEFT JOIN d5 ON d5.book_id = p.book_id LEFT JOIN d4 ON d4.book_id = p.book_id)""",
]


@query("stratified_deal_split", O.with_chain("processed", *_DEALT_SPLIT, body="""
SELECT review_id, book_id, user_id, split FROM dsplit"""))
def q_stratified_deal_split(spark, sf):
    """SP3 dealt: test = fold 0 of 5, valid = fold 0 of 4 over the rest."""
    return S.stratified_deal_split(P.processed(spark, sf)).select("review_id", "book_id", "user_id", "split")


@query("stratified_fold_balance", O.with_chain("processed", *_DEALT_SPLIT, body="""
SELECT split, n_rows, n_groups, n_users, n_rows / sum(n_rows) OVER () AS row_share
FROM (SELECT split, count(*) AS n_rows, count(DISTINCT book_id) AS n_groups,
             count(DISTINCT user_id) AS n_users FROM dsplit GROUP BY split)"""))
def q_stratified_fold_balance(spark, sf):
    """Rows, books and users per split of the dealt stratified split."""
    d = S.stratified_deal_split(P.processed(spark, sf))
    per = d.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("book_id").alias("n_groups"),
                                 F.countDistinct("user_id").alias("n_users"))
    return per.withColumn("row_share", F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy()))


@query("active_user_folds", O.with_chain(
    "deduped",
    "pu AS (SELECT user_id FROM deduped GROUP BY user_id HAVING count(*) >= 5)",
    "act AS (SELECT * FROM deduped WHERE user_id IN (SELECT user_id FROM pu))",
    _sql_deal("act", 5, 42, "da"),
    body="""
SELECT a.review_id, a.book_id, a.user_id, CASE WHEN da.fold = 0 THEN 'test' ELSE 'train' END AS split
FROM act a LEFT JOIN da ON da.book_id = a.book_id"""))
def q_active_user_folds(spark, sf):
    """SP4: active users only (>= 5 reviews), then fold 0 of 5 dealt folds is test
    (on the deduplicated corpus, where active users exist at every scale)."""
    return S.active_user_dealt_split(P.deduped(spark, sf)).select("review_id", "book_id", "user_id", "split")


@query("stratified_group_folds", O.with_chain("processed", body="""
SELECT CAST(k AS INTEGER) AS n_folds, (SELECT count(DISTINCT book_id) FROM processed) AS n_groups,
       CAST(0 AS BIGINT) AS n_split_groups, (SELECT count(*) FROM processed WHERE book_id IS NOT NULL) AS n_rows,
       true AS balanced
FROM (VALUES (5), (4), (10)) t(k)"""))
def q_stratified_group_folds(spark, sf):
    """SP3 balanced, as a contract for 5, 4 and 10 folds: every book has one
    fold, every row of a book is in it, and every fold holds 1/k of the rows
    within two points."""
    rows, out = P.processed(spark, sf), None
    counts = reliable(S.group_stratum_counts(rows))
    for k in (5, 4, 10):
        folds = S.stratified_group_folds(rows, k, counts=counts)
        per_group = folds.groupBy("book_id").agg(F.countDistinct("fold").alias("nf"))
        per_fold = (rows.join(folds, "book_id").groupBy("fold").agg(F.count(F.lit(1)).alias("n")))
        share = F.col("n") / F.sum("n").over(Window.partitionBy())  # k rows
        facts = per_fold.withColumn("ok", F.abs(share - 1.0 / k) <= 0.02).agg(
            F.sum("n").alias("n_rows"), (F.every("ok") & (F.count(F.lit(1)) == k)).alias("balanced"))
        one = per_group.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("nf") > 1).alias("n_split_groups"))
        one = one.crossJoin(facts).select(F.lit(k).alias("n_folds"), "n_groups", "n_split_groups", "n_rows", "balanced")
        out = one if out is None else out.unionByName(one)
    return out


@query("stratified_greedy_split", O.with_chain("processed", body="""
SELECT count(*) AS n_rows, count(DISTINCT book_id) AS n_groups, CAST(0 AS BIGINT) AS n_leaked, true AS near_60_20_20,
       true AS groupless_train
FROM processed"""))
def q_stratified_greedy_split(spark, sf):
    """SP3 balanced: test, valid and train with books intact, as a contract:
    no book in two splits, 60/20/20 within two points, rows without a book in
    train."""
    d = reliable(S.stratified_greedy_split(P.processed(spark, sf)).select("book_id", "split"))
    leaked = S.split_leakage(d).agg(F.count(F.lit(1)).alias("n_leaked"))
    grouped = F.col("book_id").isNotNull()
    near = [F.abs(F.count_if(grouped & (F.col("split") == x)) / F.count_if(grouped) - y) <= 0.02
            for x, y in (("train", 0.6), ("valid", 0.2), ("test", 0.2))]
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("book_id").alias("n_groups"),
                 (near[0] & near[1] & near[2]).alias("near_60_20_20"),
                 F.every(grouped | (F.col("split") == "train")).alias("groupless_train")).crossJoin(leaked)


# --- Step 4: text cleaning, n-grams, polarity --------------------------------

from tomewise.functions.constants import CONTRACTIONS  # noqa: E402
from tomewise.operators import lexicon as LX  # noqa: E402
from tomewise.operators import ngrams as NG  # noqa: E402
from tomewise.operators import sentiment as SE  # noqa: E402
from tomewise.sources import datasets as IO  # noqa: E402


@query("clean_text", O.with_chain("deduped", body=f"""
SELECT review_id, {O.sql_tokenize_filtered('review_text')} AS tok_review FROM deduped"""))
def q_clean_text(spark, sf):
    """TX5-TX13: digits, tags, quotes, non-ASCII, URLs, punctuation,
    contractions and stop words, on the deduplicated corpus."""
    return P.deduped(spark, sf).select("review_id", tx.tokenize_filtered("review_text").alias("tok_review"))


@query("strip_html_pages", O.with_chain("reviews", body="""
SELECT page_id, regexp_replace(html, '<[^\\n]*?>', '', 'g') AS text FROM pages"""))
def q_strip_html_pages(spark, sf):
    """TX6 on raw web pages."""
    return fixtures.table(spark, sf, "pages").select("page_id", tx.strip_html("html").alias("text"))


@query("strip_urls", O.with_chain("reviews", body="""
SELECT page_id, regexp_replace(concat(html, ' see ', url, ' now'), 'http[^\\x09-\\x0d\\x1c-\\x20]+', '', 'g') AS text
FROM pages"""))
def q_strip_urls(spark, sf):
    """TX9 on whole pages and their URL."""
    p = fixtures.table(spark, sf, "pages")
    src = F.concat(F.col("html"), F.lit(" see "), F.col("url"), F.lit(" now"))
    return p.select("page_id", tx.strip_urls(src).alias("text"))


@query("clean_pages", O.with_chain("reviews", body=f"""
SELECT page_id, {O.sql_tokenize_filtered("concat(html, ' see ', url, ' now')")} AS tok_page FROM pages"""))
def q_clean_pages(spark, sf):
    """TX5-TX13 on whole HTML pages with their URL appended."""
    p = fixtures.table(spark, sf, "pages")
    src = F.concat(F.col("html"), F.lit(" see "), F.col("url"), F.lit(" now"))
    return p.select("page_id", tx.tokenize_filtered(src).alias("tok_page"))


# Raw texts with contractions in them: some words become one, and every key of
# the table follows the text.
_PLANTED = [(" the ", " I can't've "), (" of ", " she'd've "), (" de ", " y'all's "), (" la ", " DON'T don't "),
            (" der ", " who'll've o'clock ")]
_KEYS = " couldna it's don't the a " + " x".join(CONTRACTIONS)


def _planted(text):
    for word, put in _PLANTED:
        text = F.replace(text, F.lit(word), F.lit(put))
    return F.concat(text, F.lit(_KEYS))


def _sql_planted(x: str) -> str:
    for word, put in _PLANTED:
        x = f"replace({x}, {O._q(word)}, {O._q(put)})"
    return f"concat({x}, {O._q(_KEYS)})"


@query("expand_contractions", f"""
SELECT doc_id, {O.sql_contractions(_sql_planted('text'))} AS expanded FROM documents""")
def q_expand_contractions(spark, sf):
    """TX11: every key of the table wherever it occurs in the raw texts."""
    d = fixtures.table(spark, sf, "documents")
    return d.select("doc_id", tx.expand_contractions(_planted(F.col("text"))).alias("expanded"))


_DECORATED = _sql_planted("review_text")


@query("expand_contractions_cleaned", O.with_chain("deduped", body=f"""
SELECT review_id, {O.sql_tokenize_filtered(_DECORATED)} AS tok_review FROM deduped"""))
def q_expand_contractions_cleaned(spark, sf):
    """TX11 in the original order (after cleaning), on decorated texts."""
    return P.deduped(spark, sf).select("review_id", tx.tokenize_filtered(_planted(F.col("review_text"))).alias("tok_review"))


def _sql_token_contractions(x: str) -> str:
    cases = " ".join(f"WHEN {O._q(k.lower())} THEN {O._q(v.lower())}" for k, v in CONTRACTIONS.items())
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: CASE w {cases} ELSE w END), ' ')")


@query("expand_contractions_tokens", O.with_chain("deduped", body=f"""
SELECT review_id, {_sql_token_contractions(O.sql_collapse("lower(" + _DECORATED + ")"))} AS expanded FROM deduped"""))
def q_expand_contractions_tokens(spark, sf):
    """TX11, whole-token mode with lower-cased keys (before cleaning)."""
    src = tx.collapse_whitespace(F.lower(_planted(F.col("review_text"))))
    return P.deduped(spark, sf).select("review_id", tx.expand_contractions(src, mode="tokens").alias("expanded"))


@query("remove_stopwords", O.with_chain("deduped", body=f"""
SELECT review_id, {O.sql_remove_stopwords('review_text')} AS text FROM deduped"""))
def q_remove_stopwords(spark, sf):
    """TX12 on the normalised texts."""
    return P.deduped(spark, sf).select("review_id", tx.remove_stopwords("review_text").alias("text"))


_CLEANED = f"cleaned AS (SELECT review_id, rating, {O.sql_tokenize_filtered('review_text')} AS tok FROM train)"


def _cleaned_train(spark, sf):
    return P.train_rows(spark, sf).select("review_id", "rating", tx.tokenize_filtered("review_text").alias("tok"))


def _sql_top_ngrams(n: int, k: int) -> str:
    return f"""
SELECT rating, ngram, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT rating, ngram, n, row_number() OVER (PARTITION BY rating ORDER BY n DESC, ngram) AS rank
  FROM (SELECT rating, ngram, count(*) AS n FROM (
          SELECT rating, unnest(list_transform(range(1, len(t) - {n} + 2),
                                lambda i: array_to_string(t[i:i + {n - 1}], ' '))) AS ngram
          FROM (SELECT rating, regexp_extract_all(lower(tok), '\\b\\w\\w+\\b') AS t FROM cleaned))
        GROUP BY rating, ngram))
WHERE rank <= {k}"""


@query("top_bigrams", O.with_chain("split", _CLEANED, body=_sql_top_ngrams(2, 10)))
def q_top_bigrams(spark, sf):
    """AG12: the 10 most frequent bigrams per rating (train, cleaned text)."""
    return NG.top_ngrams(_cleaned_train(spark, sf), "tok", 2, "rating", 10)


@query("top_trigrams", O.with_chain("split", _CLEANED, body=_sql_top_ngrams(3, 10)))
def q_top_trigrams(spark, sf):
    """AG12: the 10 most frequent trigrams per rating (train, cleaned text)."""
    return NG.top_ngrams(_cleaned_train(spark, sf), "tok", 3, "rating", 10)


@query("top_words", O.with_chain("split", _CLEANED, body="""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(tok, ' ')) AS word FROM cleaned)
WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 200"""))
def q_top_words(spark, sf):
    """AG13: the 200 most frequent cleaned words (train)."""
    return NG.top_words(_cleaned_train(spark, sf), "tok", 200)


# Query parameters: a small lexicon on words that occur in the test corpus,
# plus negators and intensifiers, standing in for a user-supplied lexicon.
LEXICON = [("de", 0.1), ("la", 0.3), ("der", -0.2), ("und", 0.5), ("que", -0.4), ("ment", 0.6),
           ("ing", -0.7), ("tion", 0.25), ("ble", 0.8), ("elle", -0.5), ("est", 0.9), ("ein", -0.9),
           ("les", 0.35), ("die", -0.15), ("ly", 0.45)]
NEGATORS = ["nicht", "kein", "pas", "ne", "no", "never"]
INTENSIFIERS = {"sehr": 1.3, "tres": 1.3, "tre": 1.5, "very": 1.3, "ou": 2.0}


def _lexicon_df(spark):
    return spark.createDataFrame(LEXICON, "word string, polarity double")


def _sql_lexicon() -> str:
    vals = ", ".join(f"({O._q(w)}, CAST({p!r} AS DOUBLE))" for w, p in LEXICON)
    return f"lex AS (SELECT * FROM (VALUES {vals}) t(word, pol))"


def _sql_polarity(negated: bool) -> str:
    s = "pol"
    if negated:
        neg = ", ".join(O._q(w) for w in NEGATORS)
        s = f"CASE WHEN prev IN ({neg}) THEN pol * -0.5 ELSE pol END"
        cases = " ".join(f"WHEN {O._q(k)} THEN CAST({v!r} AS DOUBLE)" for k, v in INTENSIFIERS.items())
        s = f"greatest(-1.0, least(1.0, ({s}) * coalesce(CASE prev {cases} END, 1.0)))"
    return f"""
pairs AS (SELECT review_id, rating, unnest(t) AS word, unnest(list_prepend(NULL, t[1:len(t) - 1])) AS prev
          FROM (SELECT review_id, rating, string_split(tok, ' ') AS t FROM cleaned)),
pol AS (SELECT review_id, rating, coalesce(avg({s}), 0.0) AS polarity
        FROM pairs LEFT JOIN lex USING (word) GROUP BY review_id, rating)"""


@query("polarity", O.with_chain("split", _CLEANED, _sql_lexicon(), _sql_polarity(False), body="""
SELECT review_id, rating, round(polarity, 6) AS polarity FROM pol"""))
def q_polarity(spark, sf):
    """TX16: mean lexicon score of the cleaned tokens (train)."""
    p = SE.polarity(_cleaned_train(spark, sf), _lexicon_df(spark), "tok", ["review_id", "rating"])
    return p.select("review_id", "rating", F.round("polarity", 6).alias("polarity"))


@query("polarity_negated", O.with_chain("split", _CLEANED, _sql_lexicon(), _sql_polarity(True), body="""
SELECT review_id, rating, round(polarity, 6) AS polarity FROM pol"""))
def q_polarity_negated(spark, sf):
    """TX17: polarity with negation and intensifier context (train)."""
    p = SE.polarity(_cleaned_train(spark, sf), _lexicon_df(spark), "tok", ["review_id", "rating"],
                    negators=NEGATORS, intensifiers=INTENSIFIERS)
    return p.select("review_id", "rating", F.round("polarity", 6).alias("polarity"))


HIGH_RATING, LOW_RATING = 4, 1  # ratings from here on, and down from here, teach the lexicon

_SQL_LEARNED = f"""
lw AS (SELECT rating, unnest(list_filter(string_split(tok, ' '), lambda w: w <> '')) AS word FROM cleaned),
lc AS (SELECT word, count(*) AS n, count_if(coalesce(rating >= {HIGH_RATING}, false)) AS h,
              count_if(coalesce(rating <= {LOW_RATING}, false)) AS l FROM lw GROUP BY word),
lt AS (SELECT word, h, l, sum(h) OVER () AS th, sum(l) OVER () AS tl,
              {float(LX.PRIOR_WORDS)!r} * n / sum(n) OVER () AS a FROM lc),
lz AS (SELECT word, (ln((h + a) / (th + {LX.PRIOR_WORDS} - h - a)) - ln((l + a) / (tl + {LX.PRIOR_WORDS} - l - a)))
              / sqrt(1 / (h + a) + 1 / (l + a)) AS z FROM lt),
lex AS (SELECT word, z, z / max(abs(z)) OVER () AS pol FROM lz WHERE abs(z) >= {LX.MIN_Z})"""


def _learned_lexicon(spark, sf):
    """Learned from the cleaned train rows, written once per input (IO9)."""
    return IO.materialize(spark, "lexicon", P._fp(sf, 42, LX.PRIOR_WORDS, LX.MIN_Z), lambda: LX.learn_lexicon(
        _cleaned_train(spark, sf), F.col("rating") >= HIGH_RATING, F.col("rating") <= LOW_RATING, "tok"))


@query("learned_lexicon", O.with_chain("split", _CLEANED, _SQL_LEARNED, body="""
SELECT word, round(pol, 6) AS polarity, round(z, 6) AS z FROM lex"""))
def q_learned_lexicon(spark, sf):
    """TX16: the words that tell high from low ratings, with their polarity."""
    return _learned_lexicon(spark, sf).select("word", F.round("polarity", 6).alias("polarity"), F.round("z", 6).alias("z"))


@query("learned_polarity", O.with_chain("split", _CLEANED, _SQL_LEARNED, _sql_polarity(True), body="""
SELECT review_id, rating, round(polarity, 6) AS polarity FROM pol"""))
def q_learned_polarity(spark, sf):
    """TX16, TX17: polarity of the cleaned texts by the learned lexicon (train)."""
    p = SE.polarity(_cleaned_train(spark, sf), _learned_lexicon(spark, sf), "tok", ["review_id", "rating"],
                    negators=NEGATORS, intensifiers=INTENSIFIERS)
    return p.select("review_id", "rating", F.round("polarity", 6).alias("polarity"))


@query("polarity_boxplot_by_rating", O.with_chain(
    "split", _CLEANED, _sql_lexicon(), _sql_polarity(False), _sql_boxplot("pol", "rating", "polarity"), body="""
SELECT st.g AS rating, st.n, st.q1, st.median, st.q3, wk2.whisker_lo, wk2.whisker_hi, ol.n_outliers
FROM st JOIN wk2 USING (g) JOIN ol USING (g)"""))
def q_polarity_boxplot_by_rating(spark, sf):
    """AG9 on polarity per rating (train); the operator writes the (rating,
    polarity) counts once and reads only them."""
    p = SE.polarity(_cleaned_train(spark, sf), _lexicon_df(spark), "tok", ["review_id", "rating"])
    return eda.boxplot_stats(p, "rating", "polarity")


# --- Step 5: scoring and evaluation on the logits fixture, vocabulary -------

from tomewise.functions import logits as LG  # noqa: E402
from tomewise.operators import metrics as M  # noqa: E402
from tomewise.operators import subwords as SW  # noqa: E402
from tomewise.operators import vocab as V  # noqa: E402


def _sql_scored(model: int = 0, lg: str = "lg", scored: str = "scored") -> str:
    """Six class scores from the whole vector (class c: elements c, c + 6, ...,
    counted from the far end for model 1), summed in that order."""
    e = "embedding" if model == 0 else "list_reverse(embedding)"
    sums = ", ".join(f"list_reduce(list_prepend(0.0::DOUBLE, list_transform(range({c}, len(embedding), 6), "
                     f"lambda k: CAST({e}[k + 1] AS DOUBLE))), lambda a, x: a + x)" for c in range(6))
    return f"""
{lg} AS (SELECT vec_id AS review_id,
              CASE WHEN vec_id % 5 = 0 THEN 'test' WHEN vec_id % 5 = 1 THEN 'valid' ELSE 'train' END AS split,
              CAST(label % 6 AS INTEGER) AS label, [{sums}] AS logits FROM embeddings),
{scored} AS (SELECT review_id, split, label, logits,
                  CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS prediction,
                  CAST(list_max(logits) AS DOUBLE) AS mx FROM {lg})"""


def _scored(spark, sf, model: int = 0):
    lg = fixtures.logits(spark, sf, model)
    return lg.withColumn("prediction", LG.argmax("logits"))


@query("argmax_logits", O.with_chain("reviews", _sql_scored(), body="""
SELECT review_id, prediction FROM scored"""))
def q_argmax_logits(spark, sf):
    """ML8: first index of the maximum logit."""
    return _scored(spark, sf).select("review_id", "prediction")


_SQL_CONF = "1.0 / list_sum(list_transform(logits, lambda x: exp(CAST(x AS DOUBLE) - mx)))"


@query("softmax_confidence", O.with_chain("reviews", _sql_scored(), body=f"""
SELECT review_id, prediction, round({_SQL_CONF}, 6) AS confidence FROM scored"""))
def q_softmax_confidence(spark, sf):
    """ML9: probability of the predicted class (stable softmax)."""
    s = _scored(spark, sf)
    return s.select("review_id", "prediction", F.round(LG.confidence("logits"), 6).alias("confidence"))


@query("label_to_rating", O.with_chain("reviews", _sql_scored(), body="""
SELECT review_id, concat('LABEL_', CAST(prediction AS VARCHAR)) AS label_name,
       CAST(split_part(concat('LABEL_', CAST(prediction AS VARCHAR)), '_', -1) AS INTEGER) AS rating
FROM scored"""))
def q_label_to_rating(spark, sf):
    """ML10: service labels ``LABEL_i`` to integer classes."""
    s = _scored(spark, sf).withColumn("label_name", LG.label_name("prediction"))
    return s.select("review_id", "label_name", LG.label_to_rating("label_name").alias("rating"))


def _model_long(spark, sf):
    """Both models' outputs from one scan of the embeddings, exploded to the
    long form (no union of per-model scans)."""
    e = fixtures.table(spark, sf, "embeddings")
    entries = []
    for model, name in ((0, "A"), (1, "B")):
        lg = fixtures.class_scores(F.col("embedding"), model)
        entries.append(F.struct(F.lit(name).alias("model_name"),
                                LG.label_to_rating(LG.label_name(LG.argmax(lg))).alias("label"),
                                F.round(LG.confidence(lg), 6).alias("score")))
    longf = e.select(F.col("vec_id").alias("review_id"), F.explode(F.array(*entries)).alias("_m"))
    return longf.select("review_id", "_m.model_name", "_m.label", "_m.score")


_SQL_MODELS = [
    _sql_scored(0, "lga", "sa"), _sql_scored(1, "lgb", "sb"),
    f"""mlong AS (SELECT review_id, 'A' AS model_name, prediction AS label, round({_SQL_CONF}, 6) AS score FROM sa
              UNION ALL
              SELECT review_id, 'B', prediction, round({_SQL_CONF}, 6) FROM sb)""",
]


@query("model_comparison", O.with_chain("reviews", *_SQL_MODELS, body="""
SELECT review_id, model_name, label, score FROM mlong"""))
def q_model_comparison(spark, sf):
    """ML11: two models on the same texts, long form (model, label, score)."""
    return _model_long(spark, sf)


@query("model_agreement", O.with_chain("reviews", *_SQL_MODELS, body="""
SELECT count(*) AS n, CAST(count_if(a = b) AS BIGINT) AS n_agree, avg(CAST(a = b AS DOUBLE)) AS agreement
FROM (SELECT review_id, max(label) FILTER (WHERE model_name = 'A') AS a,
             max(label) FILTER (WHERE model_name = 'B') AS b FROM mlong GROUP BY review_id)"""))
def q_model_agreement(spark, sf):
    """ML11: agreement rate of the two models; both labels of a row come from
    the same vector, so they are compared in place, before any shuffle."""
    e = fixtures.table(spark, sf, "embeddings")
    a, b = (LG.argmax(fixtures.class_scores(F.col("embedding"), m)) for m in (0, 1))
    return e.select((a == b).alias("same")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("same").alias("n_agree"), F.avg(F.col("same").cast("double")).alias("agreement"))


@query("eval_by_split", O.with_chain("reviews", _sql_scored(), body="""
SELECT review_id, split, label, prediction FROM scored"""))
def q_eval_by_split(spark, sf):
    """SO2: the predictions of every split in one table.  The original appends
    per-split batches; here the ``split`` column already carries that, so the
    three splits come from one scan (a union of per-split filters would scan
    the scored table three times)."""
    s = _scored(spark, sf).select("review_id", "split", "label", "prediction")
    return s.where(F.col("split").isin("train", "valid", "test"))


@query("accuracy_by_split", O.with_chain("reviews", _sql_scored(), body="""
SELECT split, count(*) AS n, avg(CAST(prediction = label AS DOUBLE)) AS accuracy FROM scored GROUP BY split"""))
def q_accuracy_by_split(spark, sf):
    """ML12: accuracy of each split."""
    return M.accuracy(_scored(spark, sf))


@query("micro_metrics", O.with_chain("reviews", _sql_scored(), body="""
SELECT split, tp / total AS precision_micro, tp / total AS recall_micro,
       CASE WHEN tp > 0 THEN tp / total ELSE 0.0 END AS f1_micro
FROM (SELECT split, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS tp, count(*) AS total
      FROM scored GROUP BY split)"""))
def q_micro_metrics(spark, sf):
    """ML13: micro precision, recall and F1 per split."""
    return M.micro_metrics(_scored(spark, sf))


@query("f1_per_class", O.with_chain("reviews", _sql_scored(), """
t AS (SELECT * FROM scored WHERE split = 'test'),
grid AS (SELECT CAST(range AS INTEGER) AS label FROM range(6)),
tp AS (SELECT label, count(*) AS tp FROM t WHERE label = prediction GROUP BY label),
nt AS (SELECT label, count(*) AS n_true FROM t GROUP BY label),
np_ AS (SELECT prediction AS label, count(*) AS n_pred FROM t GROUP BY prediction)""", body="""
SELECT label, CASE WHEN coalesce(n_true, 0) + coalesce(n_pred, 0) > 0
                   THEN 2.0 * coalesce(tp, 0) / (coalesce(n_true, 0) + coalesce(n_pred, 0)) ELSE 0.0 END AS f1
FROM grid LEFT JOIN tp USING (label) LEFT JOIN nt USING (label) LEFT JOIN np_ USING (label)"""))
def q_f1_per_class(spark, sf):
    """ML14: F1 of each of the six classes on the test split (0 where undefined)."""
    s = _scored(spark, sf).where(F.col("split") == "test")
    return M.f1_per_class(s, list(range(fixtures.N_CLASSES)))


@query("confusion_matrix", O.with_chain("reviews", _sql_scored(), """
cnt AS (SELECT split, label, prediction, count(*) AS n FROM scored GROUP BY split, label, prediction),
seen AS (SELECT split, label AS c FROM cnt UNION SELECT split, prediction FROM cnt)""", body="""
SELECT a.split, a.c AS label, b.c AS prediction, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM seen a JOIN seen b USING (split)
LEFT JOIN cnt ON cnt.split = a.split AND cnt.label = a.c AND cnt.prediction = b.c"""))
def q_confusion_matrix(spark, sf):
    """ML15: dense confusion matrix per split."""
    return M.confusion_matrix(_scored(spark, sf))


@query("adjacent_confusion_rate", O.with_chain("reviews", _sql_scored(), body="""
SELECT split, count(*) AS n_errors, CAST(count_if(abs(label - prediction) = 1) AS BIGINT) AS n_adjacent,
       count_if(abs(label - prediction) = 1) / count(*) AS adjacent_rate
FROM scored WHERE label <> prediction GROUP BY split"""))
def q_adjacent_confusion_rate(spark, sf):
    """ML16: share of errors on a neighbouring class."""
    return M.adjacent_confusion_rate(_scored(spark, sf))


@query("worst_confusions", O.with_chain("normalised", _sql_scored(), body="""
SELECT s.split, s.review_id, n.review_text, s.label FROM scored s JOIN normalised n USING (review_id)
WHERE s.split IN ('valid', 'test') AND s.label = 0 AND s.prediction = 5"""))
def q_worst_confusions(spark, sf):
    """ML17: true 0 predicted 5 on valid and test, with the review text."""
    s = _scored(spark, sf).where(F.col("split").isin("valid", "test"))
    texts = P.normalised(spark, sf).select("review_id", "review_text")
    return M.worst_confusions(s, texts, 0, 5).select("split", "review_id", "review_text", "label")


VOCAB_SIZE = 30_000
MAX_LEN = 512

_SQL_VOCAB = f"""
vocab AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) + 3 AS INTEGER) AS id, n
          FROM (SELECT word, count(*) AS n FROM (
                  SELECT unnest(list_filter(string_split(review_text, ' '), lambda w: w <> '')) AS word FROM train)
                GROUP BY word)
          ORDER BY n DESC, word LIMIT {VOCAB_SIZE})"""

_SQL_ENCODE = f"""
tk AS (SELECT review_id, split, rating,
              list_filter(string_split(review_text, ' '), lambda w: w <> '')[1:{MAX_LEN - 2}] AS t FROM splitted),
ex AS (SELECT review_id, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS pos FROM tk),
ids AS (SELECT ex.review_id, list(coalesce(v.id, 1) ORDER BY pos) AS ids
        FROM ex LEFT JOIN vocab v USING (word) GROUP BY ex.review_id),
core AS (SELECT tk.review_id, tk.split, tk.rating, list_concat([2], coalesce(ids.ids, []), [3]) AS c
         FROM tk LEFT JOIN ids USING (review_id)),
enc AS (SELECT review_id, split, rating,
               list_concat(c, list_transform(range({MAX_LEN} - len(c)), lambda x: 0)) AS input_ids,
               list_concat(list_transform(range(len(c)), lambda x: 1),
                           list_transform(range({MAX_LEN} - len(c)), lambda x: 0)) AS attention_mask
        FROM core)"""


def _vocab(spark, sf):
    """The vocabulary, written once per input and read by its users."""
    return IO.materialize(spark, "vocabulary", P._fp(sf, 42, VOCAB_SIZE),
                          lambda: V.build_vocab(P.train_rows(spark, sf), "review_text", VOCAB_SIZE))


def _encoded(spark, sf):
    rows = P.split_processed(spark, sf)
    return V.encode(rows, _vocab(spark, sf), "review_text", "review_id", MAX_LEN,
                    carry=["split", "rating"])


@query("vocab_build", O.with_chain("split", _SQL_VOCAB, body="SELECT word, id, n FROM vocab"))
def q_vocab_build(spark, sf):
    """ML1: the most frequent train words (30,000 at most) with ids from 4."""
    return V.build_vocab(P.train_rows(spark, sf), "review_text", VOCAB_SIZE)


@query("encode_ids", O.with_chain("split", _SQL_VOCAB, _SQL_ENCODE, body="""
SELECT review_id, array_to_string(input_ids, ',') AS input_ids,
       array_to_string(attention_mask, ',') AS attention_mask FROM enc"""))
def q_encode_ids(spark, sf):
    """ML2: ids and mask of length 512 for every processed review."""
    e = _encoded(spark, sf)
    return e.select("review_id", V.ids_to_string("input_ids").alias("input_ids"),
                    V.ids_to_string("attention_mask").alias("attention_mask"))


@query("project_model_inputs", O.with_chain("split", _SQL_VOCAB, _SQL_ENCODE, body="""
SELECT array_to_string(input_ids, ',') AS input_ids, array_to_string(attention_mask, ',') AS attention_mask,
       rating AS labels FROM enc WHERE split = 'train'"""))
def q_project_model_inputs(spark, sf):
    """PF1-PF3: keep the model inputs, rename rating to labels (train)."""
    e = _encoded(spark, sf).where(F.col("split") == "train")
    e = e.select("input_ids", "attention_mask", "rating").withColumnRenamed("rating", "labels")
    return e.select(V.ids_to_string("input_ids").alias("input_ids"),
                    V.ids_to_string("attention_mask").alias("attention_mask"), "labels")


@query("decode_roundtrip", O.with_chain("split", _SQL_VOCAB, _SQL_ENCODE, body="""
SELECT e.review_id, coalesce(array_to_string(list(v.word ORDER BY x.pos) FILTER (WHERE x.id >= 4), ' '), '') AS text
FROM enc e, LATERAL (SELECT unnest(e.input_ids) AS id, unnest(range(1, len(e.input_ids) + 1)) AS pos) x
LEFT JOIN vocab v ON v.id = x.id
GROUP BY e.review_id"""))
def q_decode_roundtrip(spark, sf):
    """ML3: decode(encode(text)) with special tokens skipped."""
    e = _encoded(spark, sf)
    return V.decode(e, _vocab(spark, sf), "review_id", "input_ids")


N_MERGES = 500


def _merges(spark, sf):
    """The sub-word merges of the train rows, written once per input (IO9)."""
    return IO.materialize(spark, "subword_merges", P._fp(sf, 42, N_MERGES),
                          lambda: SW.learn_merges(P.train_rows(spark, sf), n_merges=N_MERGES))


@query("subword_vocab", f"SELECT CAST({N_MERGES} AS BIGINT) AS n_merges, CAST(0 AS BIGINT) AS n_orphans, CAST(0 AS BIGINT) AS n_twice")
def q_subword_vocab(spark, sf):
    """ML1, learned sub-words, as a contract: so many merges, each of symbols
    that are bytes or come from an earlier round, none twice."""
    m = _merges(spark, sf)
    made = m.select(F.concat("left", "right").alias("side"), F.col("round").alias("made"))
    sides = m.select("id", "round", F.explode(F.array("left", "right")).alias("side"))
    orphans = sides.where(F.length("side") > 2).join(made, "side", "left").where(
        F.coalesce(F.col("made") >= F.col("round"), F.lit(True))).agg(F.count(F.lit(1)).alias("n_orphans"))
    sizes = m.agg(F.count(F.lit(1)).alias("n_merges"), (F.count(F.lit(1)) - F.countDistinct(F.concat("left", "right"))).alias("n_twice"))
    return sizes.crossJoin(orphans).select("n_merges", "n_orphans", "n_twice")  # one row each


@query("subword_roundtrip", O.with_chain("split", body="""
SELECT review_id, review_text AS text, CAST(0 AS BIGINT) AS n_unknown, true AS no_longer FROM splitted"""))
def q_subword_roundtrip(spark, sf):
    """ML2, ML3: every processed review as sub-word ids and back, whole texts."""
    rows = P.split_processed(spark, sf)
    ids = reliable(SW.encode(rows, _merges(spark, sf)))
    sizes = ids.select("review_id", F.size(F.filter("input_ids", lambda i: i.isNull())).cast("long").alias("n_unknown"),
                       F.size("input_ids").alias("n_ids"))
    back = SW.decode(ids, _merges(spark, sf)).join(sizes, "review_id")
    return back.select("review_id", "text", "n_unknown", (F.col("n_ids") <= F.octet_length("text")).alias("no_longer"))


# --- Step 6/7: training, sweep, scoring, streaming, IO -----------------------

from tomewise.operators import bayes as NB  # noqa: E402
from tomewise.operators import model as ML  # noqa: E402
from tomewise.operators.scoring import score_external, score_splits  # noqa: E402
from tomewise.streaming import scorer as ST  # noqa: E402


def _bayes(spark, sf, smoothing: float = 1.0):
    """A model of any smoothing from the (word, class) counts, which are
    written once per input (IO9)."""
    def written(counts):
        return IO.materialize(spark, "bayes_counts", P._fp(sf, 42), lambda: counts)
    return NB.count_words(P.train_rows(spark, sf), _vocab(spark, sf), write=written).smoothed(smoothing)


def _bayes_scored(spark, sf):
    """Every row of every split with its class and naive Bayes prediction."""
    rows = P.split_processed(spark, sf)
    return _bayes(spark, sf).score(rows, ["review_id", "split", "rating"]).withColumnRenamed("rating", "label")


def _sql_bayes(rows: str, smoothing: float = 1.0, name: str = "nb", keep: str = "review_id, split, rating") -> str:
    """Multinomial naive Bayes from its formula: log P(c) plus, over the text's
    known words, log((n(c, w) + s) / (n(c) + s |V|))."""
    return f"""
{name}_p AS (SELECT rating AS c, ln(count(*) / (SELECT count(*) FROM train)) AS lp FROM train GROUP BY rating),
{name}_w AS (SELECT rating AS c, unnest(list_filter(string_split(review_text, ' '), lambda w: w <> '')) AS word FROM train),
{name}_n AS (SELECT c, word, count(*) AS n FROM {name}_w JOIN vocab USING (word) GROUP BY c, word),
{name}_t AS (SELECT p.c, p.lp, coalesce(sum(n), 0) + {smoothing} * (SELECT count(*) FROM vocab) AS t
             FROM {name}_p p LEFT JOIN {name}_n USING (c) GROUP BY p.c, p.lp),
{name}_x AS (SELECT {keep}, unnest(list_filter(string_split(review_text, ' '), lambda w: w <> '')) AS word FROM {rows}),
{name}_k AS (SELECT {keep}, word, count(*) AS m FROM {name}_x JOIN vocab USING (word) GROUP BY {keep}, word),
{name}_s AS (SELECT r.review_id, t.c, any_value(t.lp) + coalesce(sum(m * ln((coalesce(n.n, 0) + {smoothing}) / t.t)), 0.0) AS l
             FROM {rows} r CROSS JOIN {name}_t t LEFT JOIN {name}_k k USING (review_id)
             LEFT JOIN {name}_n n ON n.c = t.c AND n.word = k.word GROUP BY r.review_id, t.c),
{name} AS (SELECT review_id, CAST(arg_max(c, (round(l, 9), -c)) AS INTEGER) AS prediction,
                  1.0 / sum(exp(l - top)) AS confidence
           FROM (SELECT *, max(l) OVER (PARTITION BY review_id) AS top FROM {name}_s) GROUP BY review_id)"""


_SQL_NB = [_SQL_VOCAB, _sql_bayes("splitted"), """
nbs AS (SELECT review_id, split, rating AS label, prediction, confidence FROM splitted JOIN nb USING (review_id))"""]


@query("bayes_scores", O.with_chain("split", *_SQL_NB, body="""
SELECT review_id, split, label, prediction, round(confidence, 6) AS confidence FROM nbs"""))
def q_bayes_scores(spark, sf):
    """ML4 + ML7: a classifier fitted on train scores every row of every split."""
    return _bayes_scored(spark, sf).withColumn("confidence", F.round("confidence", 6))


@query("bayes_accuracy", O.with_chain("split", *_SQL_NB, body="""
SELECT split, count(*) AS n, avg(CAST(prediction = label AS DOUBLE)) AS accuracy FROM nbs GROUP BY split"""))
def q_bayes_accuracy(spark, sf):
    """ML12 of the fitted classifier."""
    return M.accuracy(_bayes_scored(spark, sf))


@query("bayes_confusion", O.with_chain("split", *_SQL_NB, """
cnt AS (SELECT split, label, prediction, count(*) AS n FROM nbs GROUP BY split, label, prediction),
seen AS (SELECT split, label AS c FROM cnt UNION SELECT split, prediction FROM cnt)""", body="""
SELECT a.split, a.c AS label, b.c AS prediction, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM seen a JOIN seen b USING (split)
LEFT JOIN cnt ON cnt.split = a.split AND cnt.label = a.c AND cnt.prediction = b.c"""))
def q_bayes_confusion(spark, sf):
    """ML15 of the fitted classifier, every split."""
    return M.confusion_matrix(_bayes_scored(spark, sf))


@query("bayes_f1", O.with_chain("split", *_SQL_NB, """
t AS (SELECT * FROM nbs WHERE split = 'test')""", body="""
SELECT CAST(c AS INTEGER) AS label,
       coalesce(2.0 * (SELECT count(*) FROM t WHERE label = c AND prediction = c)
                / nullif((SELECT count(*) FROM t WHERE label = c) + (SELECT count(*) FROM t WHERE prediction = c), 0), 0.0) AS f1
FROM range(6) g(c)"""))
def q_bayes_f1(spark, sf):
    """ML14 of the fitted classifier on the test split."""
    return M.f1_per_class(_bayes_scored(spark, sf).where(F.col("split") == "test"), list(range(fixtures.N_CLASSES)))


@query("bayes_worst_confusions", O.with_chain("split", *_SQL_NB, body="""
SELECT split, review_id, label, prediction, review_text FROM nbs JOIN normalised USING (review_id)
WHERE label = 0 AND prediction = 5"""))
def q_bayes_worst_confusions(spark, sf):
    """ML17 of the fitted classifier: true 0 predicted 5, with the review text."""
    texts = P.normalised(spark, sf).select("review_id", "review_text")
    return M.worst_confusions(_bayes_scored(spark, sf), texts, 0, 5)


def _fit(spark, sf, kind: str = "logistic"):
    """The classifier fitted on the train split, saved once as an artifact."""
    cfg = ML.TrainConfig(kind=kind)
    return ML.fitted_model(spark, f"classifier_{kind}", P._fp(sf, 42, cfg),
                           lambda: ML.train_classifier(P.train_rows(spark, sf), cfg), IO.default_root(spark))


_SQL_ROWS_PER_SPLIT = O.with_chain("split", body="""
SELECT split, count(*) AS n, CAST(0 AS BIGINT) AS n_bad FROM splitted GROUP BY split""")


@query("train_classifier_report", _SQL_ROWS_PER_SPLIT)
def q_train_classifier_report(spark, sf):
    """ML4, logistic model, as a contract: per split every row has one
    prediction, a class from 0 to 5 with a confidence of at least 1/6."""
    scored = score_splits(_fit(spark, sf), P.split_processed(spark, sf))
    good = F.col("prediction").between(0, 5) & F.col("confidence").between(1 / 6 - 1e-9, 1 + 1e-9)
    return scored.groupBy("split").agg(F.countDistinct("review_id").alias("n"),
                                       F.count_if(~F.coalesce(good, F.lit(False))).alias("n_bad"))


SWEEP_TRIALS = 20


def _rungs(spark, sf):
    """The sweep's table of (trial, rung), written once per input (IO9)."""
    def build():
        rows = P.split_processed(spark, sf)
        return ML.halving_sweep(spark, rows.where(F.col("split") == "train"), rows.where(F.col("split") == "valid"),
                                n_trials=SWEEP_TRIALS, seed=42)
    return IO.materialize(spark, "sweep_rungs", P._fp(sf, 42, SWEEP_TRIALS), build)


def _sweep(spark, sf):
    return ML.last_rungs(_rungs(spark, sf))


def _sql_rungs() -> str:
    """Expected size of every rung: of every four trials three start in the first
    bracket, and of each rung the best third, rounded up, goes on."""
    rows = []
    for b in range(ML.BRACKETS):
        n = sum((t % 4 == 3) == (b == 1) for t in range(SWEEP_TRIALS))
        for rung in range(b, len(ML.RUNG_ITERATIONS) + 1):
            on = -(-n // ML.ETA) if rung < len(ML.RUNG_ITERATIONS) else 0
            rows.append(f"({b}, {rung}, {n}, {on}, 0, 0)")
            n = on
    return ("SELECT CAST(b AS INTEGER) AS bracket, CAST(r AS INTEGER) AS rung, CAST(n AS BIGINT) AS n_trials, "
            "CAST(s AS BIGINT) AS n_survivors, CAST(w AS BIGINT) AS n_wrong, CAST(i AS BIGINT) AS n_wrong_iterations "
            f"FROM (VALUES {', '.join(rows)}) t(b, r, n, s, w, i)")


@query("sweep_rungs", _sql_rungs())
def q_sweep_rungs(spark, sf):
    """ML5, early termination, as a contract: the size of every rung, no trial
    that goes on or stops against the order of accuracy and trial, no fit of
    another number of iterations than the rung's."""
    r = _rungs(spark, sf)
    rung = Window.partitionBy("bracket", "rung")
    place = F.row_number().over(rung.orderBy(F.col("valid_accuracy").desc(), "trial"))
    goes_on = (place <= F.ceil(F.count(F.lit(1)).over(rung) / ML.ETA)) & (F.col("rung") < len(ML.RUNG_ITERATIONS))
    wanted = F.least(F.coalesce(F.get(F.array(*map(F.lit, ML.RUNG_ITERATIONS)), F.col("rung")), "max_iter"), "max_iter")
    stays = r.where("survives").select("trial", (F.col("rung") + 1).alias("rung"), F.lit(True).alias("came_on"))
    checked = r.join(stays, ["trial", "rung"], "left").withColumn("_wrong", (F.col("survives") != goes_on) | (
        F.col("came_on").isNull() & (F.col("rung") > F.col("bracket"))))
    return checked.groupBy("bracket", "rung").agg(
        F.count(F.lit(1)).alias("n_trials"), F.count_if("survives").alias("n_survivors"),
        F.count_if("_wrong").alias("n_wrong"), F.count_if(F.col("iterations") != wanted).alias("n_wrong_iterations"))


@query("sweep_results", O.with_chain("split", body=f"""
SELECT CAST(range AS INTEGER) AS trial, true AS in_space,
       (SELECT count(*) FROM splitted WHERE split = 'valid') AS n_valid, true AS whole_rows
FROM range({SWEEP_TRIALS})"""))
def q_sweep_results(spark, sf):
    """ML5: 20 seeded random draws, as a contract: every trial once, its draw
    inside the search space, its accuracy (of its last rung) a whole number of
    validation rows."""
    n = P.split_processed(spark, sf).where(F.col("split") == "valid").agg(F.count(F.lit(1)).alias("n_valid"))
    hits = F.col("valid_accuracy") * F.col("n_valid")
    return _sweep(spark, sf).crossJoin(n).select(  # one row on the right
        "trial", (F.col("reg_param").between(1e-5, 1e-2) & F.col("max_iter").isin(25, 50, 100)
                  & F.col("num_features").isin(1 << 10, 1 << 12, 1 << 14)).alias("in_space"),
        "n_valid", ((F.abs(hits - F.round(hits)) < 1e-6) & F.col("valid_accuracy").between(0, 1)).alias("whole_rows"))


@query("sweep_best", "SELECT CAST(0 AS BIGINT) AS n_better, CAST(1 AS BIGINT) AS n_best")
def q_sweep_best(spark, sf):
    """ML6, as a contract: one best trial, and no trial of the sweep is better
    or equally good and earlier."""
    results = _sweep(spark, sf)
    best = ML.best_trial(results)
    b = best.select(F.col("trial").alias("bt"), F.col("valid_accuracy").alias("ba"))
    better = (F.col("valid_accuracy") > F.col("ba")) | ((F.col("valid_accuracy") == F.col("ba")) & (F.col("trial") < F.col("bt")))
    return results.crossJoin(b).agg(F.count_if(better).alias("n_better"), F.countDistinct("bt").alias("n_best"))


@query("score_splits", O.with_chain("split", body="""
SELECT split, count(*) AS n, CAST(0 AS BIGINT) AS n_other_class, CAST(0 AS BIGINT) AS n_other_confidence
FROM splitted GROUP BY split"""))
def q_score_splits(spark, sf):
    """ML7, Spark ML pipeline, as a contract: every row's class and confidence
    are those that the model's own weights give, computed apart from it: scores
    are intercepts plus weights times term counts times inverse frequencies."""
    model, rows = _fit(spark, sf), P.split_processed(spark, sf)
    scored = score_splits(model, rows).select("split", "review_id", "prediction", "confidence")
    return ML.recomputed(model, rows, "review_id").join(scored, "review_id").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("prediction") != F.col("own_class")) & (F.col("margin") > 1e-9)).alias("n_other_class"),
        F.count_if(F.abs(F.col("confidence") - F.col("own_confidence")) > 1e-6).alias("n_other_confidence"))


class _LetterModel:
    """Logits are counts of a few letters: stands in for a model file."""

    def predict_logits(self, texts):
        return [[float(t.count(c)) for c in "abcdef"] for t in texts]


@query("external_scores", O.with_chain("deduped", """
lc AS (SELECT review_id, list_transform(['a', 'b', 'c', 'd', 'e', 'f'],
              lambda x: CAST(length(review_text) - length(replace(review_text, x, '')) AS DOUBLE)) AS l FROM deduped)""", body="""
SELECT review_id, CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS prediction,
       round(1.0 / list_sum(list_transform(l, lambda x: exp(x - list_max(l)))), 6) AS confidence FROM lc"""))
def q_external_scores(spark, sf):
    """UD2: a model loaded by Python, once per worker, on Arrow batches."""
    out = score_external(P.deduped(spark, sf), _LetterModel, "letters", "review_text", "review_id", 6)
    return out.withColumn("confidence", F.round("confidence", 6))


def _drained(spark, base: str, df: DataFrame) -> DataFrame:
    """``df`` kept by a checkpoint while its scratch folder goes."""
    kept = reliable(df)
    remove_dir(spark, base)
    return kept


_SQL_STREAM = [_SQL_VOCAB, _sql_bayes("normalised", 1.0, "nba", "review_id"),
               _sql_bayes("normalised", 0.1, "nbb", "review_id")]


@query("stream_scores", O.with_chain("split", *_SQL_STREAM, body="""
SELECT review_id, 'smooth' AS model_name, prediction AS label, round(confidence, 6) AS score FROM nba
UNION ALL SELECT review_id, 'sharp', prediction, round(confidence, 6) FROM nbb"""))
def q_stream_scores(spark, sf):
    """ST1: all reviews land as files; a stream scores them with two models."""
    models = {"smooth": _bayes(spark, sf, 1.0), "sharp": _bayes(spark, sf, 0.1)}
    base = scratch_dir(spark, "stream")
    ST.land(fixtures.reviews(spark, sf), f"{base}/in")
    ST.start_scorer(spark, f"{base}/in", f"{base}/out", f"{base}/chk", models).awaitTermination()
    out = spark.read.parquet(f"{base}/out").select("review_id", "model_name", "label", F.round("score", 6).alias("score"))
    return _drained(spark, base, out)


@query("io_split_roundtrip", O.with_chain("split", body="""
SELECT review_id, book_id, rating, split FROM splitted WHERE split = 'train'"""))
def q_io_split_roundtrip(spark, sf):
    """IO3 + IO4: write one directory per split, read train back by pruning."""
    path = scratch_dir(spark, "splits")
    IO.write_splits(P.split_processed(spark, sf).select("review_id", "book_id", "rating", "split"), path)
    return _drained(spark, path, IO.read_split(spark, path, "train"))


@query("versioned_publish_latest", O.with_chain("processed", body="""
SELECT review_id, rating, CAST(2 AS INTEGER) AS version FROM processed"""))
def q_versioned_publish_latest(spark, sf):
    """IO5 + IO6: publish two versions, resolve ``latest`` via the manifest."""
    root = scratch_dir(spark, "registry")
    d = P.processed(spark, sf).select("review_id", "rating")
    IO.publish(spark, d.where(F.col("rating") < 3), "processed_data", root=root)
    v = IO.publish(spark, d, "processed_data", root=root)
    return _drained(spark, root, IO.read_latest(spark, "processed_data", root=root).withColumn("version", F.lit(v)))


@query("distinct_sketches", O.with_chain("processed", body="""
SELECT CAST(v AS VARCHAR) AS versions, c AS "column", true AS within_error
FROM (VALUES ('low'), ('all')) t(v), (VALUES ('user_id'), ('book_id'), ('review_id')) u(c)"""))
def q_distinct_sketches(spark, sf):
    """AG3, approximate: distinct users, books and reviews of one published
    version and of the union of two that overlap, from the sketches written
    with them, each within four standard errors of the exact count."""
    root, cols = scratch_dir(spark, "registry"), ["user_id", "book_id", "review_id"]
    d = P.processed(spark, sf).select(*cols, "rating")
    low, high = d.where(F.col("rating") <= 3), d.where(F.col("rating") >= 2)
    first = IO.publish(spark, low, "reviews", root=root, sketch=cols)
    IO.publish(spark, high, "reviews", root=root, sketch=cols)

    def close(rows, versions, label):
        exact = rows.agg(*[F.countDistinct(c).alias(c) for c in cols]).unpivot([], cols, "column", "exact")
        estimate = IO.distinct_values(spark, "reviews", versions, root)
        near = F.abs(F.col("estimate") - F.col("exact")) <= F.ceil(4 * IO.SKETCH_ERROR * F.col("exact"))
        return exact.join(estimate, "column").select(F.lit(label).alias("versions"), "column", near.alias("within_error"))

    return _drained(spark, root, close(low, [first], "low").unionByName(close(d, None, "all")))


_NA = ", ".join(O._q(x) for x in IO.NA_STRINGS)


@query("io_csv_roundtrip", O.with_chain("normalised", f"""
planted AS (SELECT review_id, CASE WHEN review_id % 3 = 0 THEN ([{_NA}, 'n', 'NAN', 'nil'])[1 + (review_id // 3) % {len(IO.NA_STRINGS) + 3}]
                              ELSE review_text END AS review_text, rating FROM normalised)""", body=f"""
SELECT review_id, CASE WHEN review_text NOT IN ({_NA}) THEN review_text END AS review_text, rating FROM planted"""))
def q_io_csv_roundtrip(spark, sf):
    """IO1 + IO2: multi-line quoted texts survive a CSV write and read, and all
    strings that stand for a missing value are read as null."""
    path = scratch_dir(spark, "csv")
    odd = F.array(*[F.lit(x) for x in [*IO.NA_STRINGS, "n", "NAN", "nil"]])
    at = (F.floor(F.col("review_id") / 3) % (len(IO.NA_STRINGS) + 3)).cast("int")
    d = P.normalised(spark, sf).withColumn("review_text", F.when(
        F.col("review_id") % 3 == 0, F.get(odd, at)).otherwise(F.col("review_text")))
    IO.write_csv(d.select("review_id", "review_text", "rating"), path)
    schema = T.StructType.fromDDL("review_id bigint, review_text string, rating int")
    return _drained(spark, path, IO.read_csv(spark, path, schema))


@query("published_table", O.with_chain("split", body="""
SELECT split, rating, count(*) AS n FROM splitted GROUP BY split, rating"""))
def q_published_table(spark, sf):
    """IO7: a result table written for later inspection and read again."""
    path = scratch_dir(spark, "tables")
    IO.publish_table(P.split_processed(spark, sf).groupBy("split", "rating").agg(F.count(F.lit(1)).alias("n")), path)
    return _drained(spark, path, spark.read.parquet(path))


@query("metric_log", O.with_chain("reviews", _sql_scored(), body="""
SELECT 'run-a' AS run_id, split || '_n' AS key, CAST(count(*) AS DOUBLE) AS value FROM scored GROUP BY split
UNION ALL SELECT 'run-a', split || '_accuracy', avg(CAST(prediction = label AS DOUBLE)) FROM scored GROUP BY split
UNION ALL SELECT 'run-b', split || '_wide_misses', CAST(count_if(abs(prediction - label) > 2) AS DOUBLE) FROM scored GROUP BY split"""))
def q_metric_log(spark, sf):
    """IO8 + UD3: metrics, one of them registered by the user, logged by run."""
    root, scored = scratch_dir(spark, "log"), _scored(spark, sf)
    M.register_metric("wide_misses", lambda d: d.groupBy("split").agg(
        F.count_if(F.abs(F.col("prediction") - F.col("label")) > 2).alias("wide_misses")))
    made = M.compute_metrics(scored, ["accuracy", "wide_misses"])
    IO.log_metric_table(made["accuracy"], "run-a", ["split"], root)
    IO.log_metric_table(made["wide_misses"], "run-b", ["split"], root)
    return _drained(spark, root, IO.read_metrics(spark, root).select("run_id", "key", "value"))


@query("stage_skip", O.with_chain("processed", body="""
SELECT rating, count(*) AS n, CAST(1 AS INTEGER) AS n_builds FROM processed GROUP BY rating"""))
def q_stage_skip(spark, sf):
    """IO9: a stage asked for twice is built once."""
    root, builds = scratch_dir(spark, "stages"), []

    def build():
        builds.append(1)
        return P.processed(spark, sf).select("review_id", "rating")
    for _ in range(2):
        stage = IO.materialize(spark, "ratings", P._fp(sf, 42), build, root)
    out = stage.groupBy("rating").agg(F.count(F.lit(1)).alias("n")).withColumn("n_builds", F.lit(len(builds)))
    return _drained(spark, root, out)


@query("reload_if_empty", O.with_chain("processed", body="""
SELECT 'empty' AS given, review_id, rating FROM processed
UNION ALL SELECT 'full', review_id, rating FROM processed WHERE rating >= 3"""))
def q_reload_if_empty(spark, sf):
    """IO10: the stored rows are read again when there are none in hand."""
    d = P.processed(spark, sf).select("review_id", "rating")
    out = None
    for name, have in (("empty", d.where(F.col("rating") > 9)), ("full", d.where(F.col("rating") >= 3))):
        one = IO.reload_if_empty(have, lambda: d).select(F.lit(name).alias("given"), "review_id", "rating")
        out = one if out is None else out.unionByName(one)
    return out


@query("row_keys", """
SELECT text, count(*) AS n_rows, count(*) AS n_keys FROM documents GROUP BY text""")
def q_row_keys(spark, sf):
    """PF8: keys for rows that have none, distinct also among equal rows: as
    many keys as rows for every text."""
    d = fixtures.with_row_key(fixtures.table(spark, sf, "documents").select("text"), ["text"])
    texts = d.groupBy("text").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("review_id").alias("n_keys"))
    shared = d.groupBy("review_id").count().where("count > 1").agg(F.count(F.lit(1)).alias("shared"))  # one row: 0
    return texts.crossJoin(shared).select("text", "n_rows", (F.col("n_keys") - F.col("shared")).alias("n_keys"))


# --- Second data sets: dialogue turns, events, binary labels -----------------

C_DIALOGUE = f"""
dialogue AS (SELECT CAST(conv_id AS BIGINT) * 4294967296 + turn AS review_id, conv_id AS book_id, turn, role,
                    trim(regexp_replace(lower(text), {O.WS}, ' ', 'g')) AS review_text
             FROM conversations)"""


def _dialogue(spark, sf):
    return fixtures.dialogue_reviews(spark, sf)


@query("dialogue_undersample", O.with_chain("reviews", C_DIALOGUE, """
role_n AS (SELECT role, count(*) AS n FROM dialogue WHERE role IS NOT NULL GROUP BY role)""", body="""
SELECT review_id, book_id, role FROM (
  SELECT *, row_number() OVER (PARTITION BY role
            ORDER BY md5(concat('42', ':', CAST(review_id AS VARCHAR))), review_id) AS rn
  FROM dialogue WHERE role IS NOT NULL)
WHERE rn <= (SELECT min(n) FROM role_n)"""))
def q_dialogue_undersample(spark, sf):
    """SP1 on a second, strongly imbalanced corpus (class = speaker role)."""
    from tomewise.operators.sampling import undersample
    return undersample(_dialogue(spark, sf), "role", 42).select("review_id", "book_id", "role")


_C_DIALOGUE_SPLIT = C_DIALOGUE + ", " + O.C_SPLIT.replace("FROM processed", "FROM dialogue").replace(
    "processed p", "dialogue p")


@query("dialogue_group_split", O.with_chain("reviews", _C_DIALOGUE_SPLIT, body="""
SELECT review_id, book_id, split FROM splitted"""))
def q_dialogue_group_split(spark, sf):
    """SP2 exact on conversations: no conversation in two splits."""
    return S.group_split_exact(_dialogue(spark, sf)).select("review_id", "book_id", "split")


@query("dialogue_split_class_mix", O.with_chain("reviews", _C_DIALOGUE_SPLIT, body="""
SELECT split, role, n_rows, n_rows / sum(n_rows) OVER (PARTITION BY split) AS share
FROM (SELECT split, role, count(*) AS n_rows FROM splitted GROUP BY split, role)"""))
def q_dialogue_split_class_mix(spark, sf):
    """SP5 on conversations: role mix per split."""
    return S.split_class_mix(S.group_split_exact(_dialogue(spark, sf)), "role")


_EV = "ev_n AS (SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id)"


@query("event_activity_describe", O.with_chain("reviews", _EV, body="""
SELECT count(n) AS count, avg(n) AS mean, stddev_samp(n) AS std, CAST(min(n) AS DOUBLE) AS min,
       CAST(quantile_cont(n, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS q50,
       CAST(quantile_cont(n, 0.75) AS DOUBLE) AS q75, CAST(max(n) AS DOUBLE) AS max FROM ev_n"""))
def q_event_activity_describe(spark, sf):
    """AG7 on a second activity table: events per user."""
    return eda.describe(eda.counts_table(fixtures.events_activity(spark, sf), "user_id", "n"), "n")


@query("event_activity_hist", O.with_chain("reviews", _EV, """
rng AS (SELECT CASE WHEN min(n) = max(n) THEN CAST(min(n) AS DOUBLE) - 0.5 ELSE CAST(min(n) AS DOUBLE) END AS lo_,
               CASE WHEN min(n) = max(n) THEN CAST(max(n) AS DOUBLE) + 0.5 ELSE CAST(max(n) AS DOUBLE) END AS hi_
        FROM ev_n)""", body="""
SELECT b.bin, (SELECT lo_ FROM rng) + b.bin * (((SELECT hi_ FROM rng) - (SELECT lo_ FROM rng)) / 50.0) AS lo,
       (SELECT lo_ FROM rng) + (b.bin + 1) * (((SELECT hi_ FROM rng) - (SELECT lo_ FROM rng)) / 50.0) AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) b
LEFT JOIN (SELECT least(CAST(floor((CAST(n AS DOUBLE) - (SELECT lo_ FROM rng)) * 50.0
                                   / ((SELECT hi_ FROM rng) - (SELECT lo_ FROM rng))) AS INTEGER), 49) AS bin,
                  count(*) AS n
           FROM ev_n GROUP BY 1) c USING (bin)"""))
def q_event_activity_hist(spark, sf):
    """AG6 on events per user: 50 bins over the data range."""
    return eda.histogram_over_range(eda.counts_table(fixtures.events_activity(spark, sf), "user_id", "n"), "n", 50)


@query("event_value_boxplot_by_type", O.with_chain("reviews", _sql_boxplot("events", "event_type", "value"), body="""
SELECT st.g AS event_type, st.n, st.q1, st.median, st.q3, wk2.whisker_lo, wk2.whisker_hi, ol.n_outliers
FROM st JOIN wk2 USING (g) JOIN ol USING (g)"""))
def q_event_value_boxplot_by_type(spark, sf):
    """AG9 on event values per event type."""
    return eda.boxplot_stats(fixtures.events_activity(spark, sf), "event_type", "value")


@query("quality_label_mix", O.with_chain("deduped", body="""
SELECT d.rating, l.quality, count(*) AS n FROM deduped d LEFT JOIN labels l ON l.doc_id = d.review_id
GROUP BY d.rating, l.quality"""))
def q_quality_label_mix(spark, sf):
    """A second, binary label joined to the reviews (left join; unlabelled
    reviews keep a null quality)."""
    lab = fixtures.table(spark, sf, "labels").select(F.col("doc_id").alias("review_id"), "quality")
    d = P.deduped(spark, sf).select("review_id", "rating").join(lab, "review_id", "left")
    return d.groupBy("rating", "quality").agg(F.count(F.lit(1)).alias("n"))


@query("quality_undersample", O.with_chain("deduped", """
lab AS (SELECT d.review_id, l.quality FROM deduped d JOIN labels l ON l.doc_id = d.review_id),
q_n AS (SELECT quality, count(*) AS n FROM lab WHERE quality IS NOT NULL GROUP BY quality)""", body="""
SELECT review_id, quality FROM (
  SELECT *, row_number() OVER (PARTITION BY quality
            ORDER BY md5(concat('42', ':', CAST(review_id AS VARCHAR))), review_id) AS rn
  FROM lab WHERE quality IS NOT NULL)
WHERE rn <= (SELECT min(n) FROM q_n)"""))
def q_quality_undersample(spark, sf):
    """SP1 on the binary quality label of the labelled reviews."""
    from tomewise.operators.sampling import undersample
    lab = fixtures.table(spark, sf, "labels").select(F.col("doc_id").alias("review_id"), "quality")
    # written once: the sampler reads its input in several passes
    d = reliable(P.deduped(spark, sf).select("review_id").join(lab, "review_id"))
    return undersample(d, "quality", 42).select("review_id", "quality")
