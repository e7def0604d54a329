"""ML1-ML3: vocabulary, encoding to fixed-length ids with a mask, decoding.

A re-aim of a pretrained sub-word tokenizer: words of the normalised text
(split on single spaces), ids by training-set frequency.  Special tokens
take ids 0..3 ([PAD], [UNK], [CLS], [SEP]).

Plans: the vocabulary is a top-V aggregate (``TakeOrderedAndProject``); it
is broadcast to the token join after a check of its size, else both sides are
shuffled.
Encoding explodes at most ``max_length - 2`` tokens per text (the
truncation itself), looks them up, and regroups by ``review_id``: one
shuffle of small (id, position, token id) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewise.functions.constants import CLS, PAD, SEP, UNK
from tomewise.operators.joins import broadcast_if_bounded

N_SPECIAL = 4


def _words(text_col: str):
    return F.filter(F.split(F.col(text_col), " "), lambda w: w != "")


def build_vocab(df: DataFrame, text_col: str = "review_text", size: int = 30_000) -> DataFrame:
    """``word, id, n``: the ``size`` most frequent words, ids from 4."""
    counts = (df.select(F.explode(_words(text_col)).alias("word"))
                .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.col("n").desc(), F.col("word")).limit(size)
    w = Window.orderBy(F.col("n").desc(), F.col("word"))  # over <= size rows
    return top.withColumn("id", (F.row_number().over(w) + N_SPECIAL - 1).cast("int")).select("word", "id", "n")


def encode(df: DataFrame, vocab: DataFrame, text_col: str = "review_text", key: str = "review_id",
           max_length: int = 512, carry: list[str] | tuple = ()) -> DataFrame:
    """``key, carry..., input_ids, attention_mask`` (arrays of int, length
    ``max_length``): [CLS] ids [SEP] then [PAD]s; unknown words map to [UNK].

    ``carry`` columns (functions of ``key``, e.g. split and label) ride along
    in the grouping key, so callers never join the wide encoded table back
    to the rows."""
    body = max_length - 2
    keys = [key, *carry]
    toks = df.select(*keys, F.slice(_words(text_col), 1, body).alias("_t"))
    ex = toks.select(*keys, F.posexplode_outer("_t").alias("pos", "word"))
    v = broadcast_if_bounded(vocab.select("word", "id"))
    looked = ex.join(v, "word", "left").select(
        *keys, "pos", F.when(F.col("pos").isNotNull(), F.coalesce("id", F.lit(UNK))).alias("id"))
    grouped = looked.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "id")))).alias("_s"))
    ids = F.transform(F.col("_s"), lambda s: s["id"])
    core = F.concat(F.array(F.lit(CLS)), ids, F.array(F.lit(SEP)))
    pad = F.array_repeat(F.lit(PAD), F.lit(max_length) - F.size(core))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(core)), F.array_repeat(F.lit(0), F.lit(max_length) - F.size(core)))
    return grouped.select(*keys, F.concat(core, pad).cast("array<int>").alias("input_ids"),
                          mask.cast("array<int>").alias("attention_mask"))


def decode(encoded: DataFrame, vocab: DataFrame, key: str = "review_id",
           ids_col: str = "input_ids") -> DataFrame:
    """``key, text``: ids back to words, special tokens skipped."""
    # padding and other special ids go before the explode
    ex = encoded.select(key, F.posexplode_outer(F.filter(ids_col, lambda i: i >= N_SPECIAL)).alias("pos", "id"))
    v = broadcast_if_bounded(vocab.select("word", "id"))
    words = (ex.join(v, "id", "left")
               .select(key, F.when(F.col("id").isNotNull(), F.struct("pos", "word")).alias("_w")))
    g = words.groupBy(key).agg(F.array_sort(F.collect_list("_w")).alias("_s"))
    return g.select(key, F.array_join(F.transform("_s", lambda s: s["word"]), " ").alias("text"))


def ids_to_string(c) -> F.Column:
    """Array of ints as a comma-separated string (for oracle comparison)."""
    return F.array_join(F.col(c).cast("array<string>"), ",")
