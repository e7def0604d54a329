"""AG12 per-class n-gram frequencies and AG13 corpus word frequencies.

Tokens are exploded and counted with map-side partial aggregation; the top
k per class uses a literal ``row_number() <= k`` so Spark prunes each task's
candidates (``WindowGroupLimit``) before the class shuffle.  The corpus is
never concatenated and no vocabulary reaches the driver.

Most distinct n-grams are rare, so the top k are found behind a count sketch
(``exact_top``), and only n-grams that may be among them are ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewise.functions.text import ngrams, word_tokens
from tomewise.operators.joins import broadcast_if_bounded
from tomewise.session import reliable

# Counters per class of the sketch in front of the exact counts.
SKETCH_BUCKETS = 1 << 16


def exact_top(items: DataFrame, item: str, k: int, class_col: str | None = None, name: str = "n",
              buckets: int | None = SKETCH_BUCKETS) -> DataFrame:
    """``[class_col,] item, name, rank``: the ``k`` most frequent items (of each
    class) by (count desc, item), exactly, from rows of one item each.

    Items are hashed into ``buckets`` counters (None: one per 64-bit hash), so
    a counter is at least the count of any item in it.  Counting the items of
    the ``k`` largest counters exactly gives a bar: the ``k``-th largest of
    these counts (0 if there are fewer) is at most the ``k``-th largest of all.
    An item of the true top ``k`` has at least that many occurrences, so its
    counter reaches the bar; only items of counters that do are counted, and
    the best ``k`` of them are the best of all.  Shuffled are the counters and
    those items; the items are read three times."""
    keys = [class_col] if class_col else []
    digest = F.xxhash64(item)
    tagged = items.withColumn("_b", digest if buckets is None else F.pmod(digest, F.lit(buckets)))
    sketch = reliable(tagged.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_u")))
    per_class = Window.partitionBy(*keys)

    def top(df: DataFrame, *order) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(per_class.orderBy(*order))).where(F.col("rank") <= k)

    def counted(of: DataFrame) -> DataFrame:
        some = of.select(F.col("_b").alias("_of"), *[F.col(c).alias("_class") for c in keys])
        on = F.col("_b") == F.col("_of")
        for c in keys:
            on = on & F.col(c).eqNullSafe(F.col("_class"))
        kept = tagged.join(broadcast_if_bounded(some), on, "left_semi")
        return top(kept.groupBy(*keys, item).agg(F.count(F.lit(1)).alias(name)), F.col(name).desc(), F.col(item))

    first = counted(top(sketch, F.col("_u").desc(), "_b").drop("rank"))
    bars = first.groupBy(*keys).agg(F.when(F.count(F.lit(1)) == k, F.min(name)).otherwise(0).alias("_bar"))
    bars = bars.select("_bar", *[F.col(c).alias("_class") for c in keys])  # one row, or one per class
    above = F.col("_u") >= F.col("_bar")
    for c in keys:
        above = above & F.col(c).eqNullSafe(F.col("_class"))
    return counted(sketch.join(broadcast_if_bounded(reliable(bars)), above, "left_semi"))


def each_ngram(df: DataFrame, text_col: str, n: int, class_col: str | None = None) -> DataFrame:
    """``[class,] ngram``: a row per n-gram of the word tokens of ``text_col``."""
    keys = [class_col] if class_col else []
    # Tokens are projected first so the n-gram lambda reads a column instead
    # of re-running the tokenizer for every position (linear, not quadratic).
    toks = df.select(*keys, word_tokens(text_col).alias("_toks"))
    return toks.select(*keys, F.explode(ngrams("_toks", n)).alias("ngram"))


def ngram_counts(df: DataFrame, text_col: str, n: int, class_col: str | None = None) -> DataFrame:
    """``[class,] ngram, n`` over the word tokens of ``text_col``."""
    keys = [class_col] if class_col else []
    return each_ngram(df, text_col, n, class_col).groupBy(*keys, "ngram").agg(F.count(F.lit(1)).alias("n"))


def top_ngrams(df: DataFrame, text_col: str, n: int, class_col: str, k: int = 10,
               buckets: int | None = SKETCH_BUCKETS) -> DataFrame:
    """Top ``k`` n-grams per class by (count desc, n-gram), with their rank."""
    return exact_top(each_ngram(df, text_col, n, class_col), "ngram", k, class_col, buckets=buckets)


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Frequency of each space-separated word (empty tokens dropped)."""
    words = df.select(F.explode(F.split(F.col(text_col), " ")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(df: DataFrame, text_col: str, k: int = 200) -> DataFrame:
    """The ``k`` most frequent words (data behind a word cloud)."""
    return word_counts(df, text_col).orderBy(F.col("n").desc(), F.col("word")).limit(k)
