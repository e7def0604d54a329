"""TX16/TX17: a polarity lexicon learned from ratings.

A word's polarity is how much likelier it is in texts of high than of low
rating: the difference of its log-odds, each with an informative Dirichlet
prior (the word's share of all texts times ``prior_words``), so that a rare
word needs no less evidence than a frequent one, divided by its standard error.
Words beyond ``min_z`` standard errors are kept and scaled to -1..1.

One aggregate of word counts with map-side combine; the totals are one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewise.session import reliable

PRIOR_WORDS = 1_000
MIN_Z = 1.96


def word_odds(df: DataFrame, high: Column, low: Column, text_col: str, prior_words: float = PRIOR_WORDS) -> DataFrame:
    """``word, n, n_high, n_low, log_odds, z`` of every word; ``high`` and
    ``low`` tell the rows of either side, and all rows make the prior."""
    words = df.select(F.explode(F.filter(F.split(F.col(text_col), " "), lambda w: w != "")).alias("word"),
                      F.coalesce(high, F.lit(False)).alias("_h"), F.coalesce(low, F.lit(False)).alias("_l"))
    counts = reliable(words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if("_h").alias("n_high"),
                                                F.count_if("_l").alias("n_low")))
    n, n_high, n_low = counts.agg(F.sum("n"), F.sum("n_high"), F.sum("n_low")).head()
    prior = F.lit(float(prior_words)) * F.col("n") / F.lit(n or 1)

    def log_odds(count: str, total: int) -> Column:
        seen = F.col(count) + prior
        return F.log(seen / (F.lit((total or 0) + float(prior_words)) - seen))

    odds = log_odds("n_high", n_high) - log_odds("n_low", n_low)
    error = F.sqrt(1 / (F.col("n_high") + prior) + 1 / (F.col("n_low") + prior))
    return counts.select("word", "n", "n_high", "n_low", odds.alias("log_odds"), (odds / error).alias("z"))


def learn_lexicon(df: DataFrame, high: Column, low: Column, text_col: str = "review_text",
                  prior_words: float = PRIOR_WORDS, min_z: float = MIN_Z) -> DataFrame:
    """``word, polarity, z``: the words whose ``z`` is at least ``min_z`` in
    size, with ``z`` as a share of the largest as polarity."""
    kept = reliable(word_odds(df, high, low, text_col, prior_words).where(F.abs("z") >= min_z).select("word", "z"))
    most = kept.agg(F.max(F.abs("z"))).head()[0]
    return kept.select("word", (F.col("z") / F.lit(most or 1.0)).alias("polarity"), "z")
