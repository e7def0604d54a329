"""TX16/TX17: lexicon polarity of texts, re-aimed as a join.

A text's polarity is the mean lexicon score of its tokens that the lexicon
knows (0.0 if none).  With ``negators``/``intensifiers`` a token preceded by
a negator has its score multiplied by ``negation_weight``; one preceded by
an intensifier is multiplied by its intensity and clipped to [-1, 1].

Plan: tokens are exploded together with the previous token (an array zip,
so no window and no shuffle of tokens), joined to the lexicon, and averaged
per text.  Every token row of a text sits in the text's own partition, so
the partial aggregate leaves one row per text before the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewise.operators.joins import broadcast_if_bounded

MAX_BROADCAST_LEXICON = 2_000_000


def _lexicon_side(lexicon: DataFrame, max_rows: int = MAX_BROADCAST_LEXICON) -> DataFrame:
    """Broadcast the lexicon after checking its size; shuffle-join beyond it."""
    return broadcast_if_bounded(lexicon, max_rows)


def polarity(df: DataFrame, lexicon: DataFrame, text_col: str, key_cols: list[str],
             negators: list[str] | None = None, intensifiers: dict | None = None,
             negation_weight: float = -0.5) -> DataFrame:
    """``key_cols..., polarity`` for every row of ``df`` (keys must be unique)."""
    d = df.select(*key_cols, F.split(F.col(text_col), " ").alias("_w"))
    toks = F.col("_w")
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice(toks, 1, F.greatest(F.size(toks) - 1, F.lit(0))))
    pairs = d.select(*key_cols, F.explode_outer(F.arrays_zip(toks.alias("w"), prev.alias("p"))).alias("_t"))
    pairs = pairs.select(*key_cols, F.col("_t.w").alias("word"), F.col("_t.p").alias("prev"))
    lex = _lexicon_side(lexicon.select(F.col("word"), F.col("polarity").cast("double").alias("_pol")))
    scored = pairs.join(lex, "word", "left")
    s = F.col("_pol")
    if negators:
        s = F.when(F.col("prev").isin(*negators), s * F.lit(negation_weight)).otherwise(s)
    if intensifiers:
        inten = F.create_map(*[x for k, v in intensifiers.items() for x in (F.lit(k), F.lit(float(v)))])
        factor = F.coalesce(F.element_at(inten, F.col("prev")), F.lit(1.0))
        s = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s * factor))
    return (scored.groupBy(*key_cols)
                  .agg(F.coalesce(F.avg(s), F.lit(0.0)).alias("polarity")))
