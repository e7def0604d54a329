"""Multinomial naive Bayes over the vocabulary, as DataFrame aggregates.

Fitting is one aggregate of (class, word) counts with map-side combine, from
which a model of any smoothing follows; the model is two small tables: the classes' log priors and, per vocabulary word,
an array of log likelihoods in class order.  Scoring joins a text's distinct
words with the likelihoods (broadcast after a size check, shuffled beyond it),
sums per text and takes the best class.  Nothing runs in one task, and the
whole model can be stated in SQL.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewise.functions.logits import argmax, confidence
from tomewise.operators.joins import broadcast_if_bounded
from tomewise.session import reliable


def _words(text_col: str):
    return F.filter(F.split(F.col(text_col), " "), lambda w: w != "")


@dataclass(frozen=True)
class NaiveBayes:
    """``classes`` in order, their log priors, and ``word, lik`` (one log
    likelihood per class) of the vocabulary's words."""

    classes: list
    log_priors: list[float]
    likelihoods: DataFrame

    def score(self, df: DataFrame, keep: list[str], text_col: str = "review_text") -> DataFrame:
        """``keep..., prediction, confidence``; ties go to the smaller class.
        ``keep`` must name the rows; words outside the vocabulary are skipped."""
        words = df.select(*keep, F.explode_outer(_words(text_col)).alias("word"))
        seen = words.join(broadcast_if_bounded(self.likelihoods), "word", "left")
        sums = [(F.coalesce(F.sum(F.col("lik")[i]), F.lit(0.0)) + F.lit(p)).alias(f"_l{i}")
                for i, p in enumerate(self.log_priors)]
        per = seen.groupBy(*keep).agg(*sums).withColumn("_l", F.array(*[f"_l{i}" for i in range(len(sums))]))
        return per.select(*keep, F.element_at(F.array(*[F.lit(c) for c in self.classes]), argmax("_l") + 1)
                          .alias("prediction"), confidence("_l").alias("confidence"))


@dataclass(frozen=True)
class WordCounts:
    """What fitting reads from the corpus: ``classes`` in order, their rows, and
    ``word, counts`` (one number per class) of the vocabulary's words.  Any
    smoothing follows from it without another pass over the texts."""

    classes: list
    rows: list[int]
    words: DataFrame

    def smoothed(self, smoothing: float = 1.0) -> NaiveBayes:
        total = sum(self.rows)
        k = range(len(self.classes))
        n_words, *sums = self.words.agg(F.count(F.lit(1)), *[F.sum(F.col("counts")[i]) for i in k]).head()
        lik = F.array(*[F.log((F.col("counts")[i] + F.lit(smoothing)) / F.lit((sums[i] or 0) + smoothing * n_words))
                        for i in k])
        return NaiveBayes(self.classes, [math.log(n / total) for n in self.rows], self.words.select("word", lik.alias("lik")))


def count_words(train: DataFrame, vocab: DataFrame, text_col: str = "review_text", label_col: str = "rating",
                write=reliable) -> WordCounts:
    """The counts of the rows with a label; ``vocab`` has a column ``word``.
    ``write`` keeps the table of counts (a checkpoint, or a stage of its own)."""
    d = train.where(F.col(label_col).isNotNull())
    per_class = d.groupBy(label_col).count().orderBy(label_col).collect()  # one row per class
    classes = [r[0] for r in per_class]
    counts = (d.select(label_col, F.explode(_words(text_col)).alias("word"))
               .groupBy("word").agg(F.array(*[F.count_if(F.col(label_col) == F.lit(c)) for c in classes]).alias("counts")))
    none = F.array(*[F.lit(0).cast("bigint") for _ in classes])
    known = vocab.select("word").join(counts, "word", "left").select("word", F.coalesce("counts", none).alias("counts"))
    return WordCounts(classes, [r["count"] for r in per_class], write(known))


def fit(train: DataFrame, vocab: DataFrame, smoothing: float = 1.0, text_col: str = "review_text",
        label_col: str = "rating") -> NaiveBayes:
    """Fits on the rows with a label; ``vocab`` has a column ``word``."""
    return count_words(train, vocab, text_col, label_col).smoothed(smoothing)
