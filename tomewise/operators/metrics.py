"""Evaluation from one scored table ``(review_id, split, label, prediction)``
(ML12-ML17).

Everything derives from a single ``groupBy(split, label, prediction)``
count: a table of at most splits x classes^2 rows, however large the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewise.operators.joins import broadcast_if_bounded
from tomewise.session import reliable


def confusion_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sparse confusion table ``by..., label, prediction, n``."""
    by = by or ["split"]
    return scored.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Dense confusion matrix per split over the labels seen in that split
    (true or predicted), zero cells included."""
    by = by or ["split"]
    # at most splits x classes^2 cells, read three times below: written once
    # so the scored rows are aggregated in a single pass
    counts = reliable(confusion_counts(scored, by))
    seen = (counts.select(*by, F.col("label").alias("c"))
                  .unionByName(counts.select(*by, F.col("prediction").alias("c"))).distinct())
    # class x class grid per split: bounded by the number of classes, not rows
    grid = (seen.withColumnRenamed("c", "label")
                .join(seen.withColumnRenamed("c", "prediction"), by))
    return (grid.join(counts, by + ["label", "prediction"], "left")
                .select(*by, "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def accuracy(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or ["split"]
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def micro_metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Micro precision, recall and F1 (equal to accuracy for single labels)."""
    by = by or ["split"]
    c = confusion_counts(scored, by)
    agg = c.groupBy(*by).agg(
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("total"))
    fp = F.col("total") - F.col("tp")
    p = F.col("tp") / (F.col("tp") + fp)
    r = F.col("tp") / (F.col("tp") + (F.col("total") - F.col("tp")))
    return agg.select(*by, p.alias("precision_micro"), r.alias("recall_micro"),
                      F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1_micro"))


def f1_per_class(scored: DataFrame, classes: list[int]) -> DataFrame:
    """F1 of each listed class; 0.0 where undefined (no true and no predicted)."""
    spark = scored.sparkSession
    # One pass over the scored rows: each row counts once for its true class
    # (and as a hit when correct) and once for its predicted class; the
    # aggregate combines map-side into one row per class.
    correct = (F.col("label") == F.col("prediction")).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("c"), F.lit(1).cast("long").alias("t"), correct.alias("h"),
                 F.lit(0).cast("long").alias("p")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("long").alias("t"),
                 F.lit(0).cast("long").alias("h"), F.lit(1).cast("long").alias("p")))
    per = (scored.select(F.explode(sides).alias("_s"))
                 .groupBy(F.col("_s.c").alias("c"))
                 .agg(F.sum("_s.h").alias("tp"), F.sum("_s.t").alias("n_true"), F.sum("_s.p").alias("n_pred")))
    grid = spark.createDataFrame([(int(c),) for c in classes], "c int")  # the class list parameter
    j = grid.join(per, "c", "left").fillna(0, ["tp", "n_true", "n_pred"])
    den = F.col("n_true") + F.col("n_pred")
    return j.select(F.col("c").alias("label"),
                    F.when(den > 0, 2.0 * F.col("tp") / den).otherwise(0.0).alias("f1"))


def adjacent_confusion_rate(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of errors that land on a neighbouring class (|label - pred| = 1)."""
    by = by or ["split"]
    err = scored.where(F.col("label") != F.col("prediction"))
    return err.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.count_if(F.abs(F.col("label") - F.col("prediction")) == 1).alias("n_adjacent")).withColumn(
        "adjacent_rate", F.col("n_adjacent") / F.col("n_errors"))


def worst_confusions(scored: DataFrame, texts: DataFrame, true_label: int = 0, predicted: int = 5,
                     key: str = "review_id") -> DataFrame:
    """PF5 + J3: ``split, key, label, prediction`` and the texts' columns of the
    rows with the given true and predicted class."""
    # The hits are one cell of the confusion matrix.  They are written once
    # (scoring is not repeated by the size check), without wide columns, then
    # broadcast after the check so the text table is scanned, not shuffled.
    hits = reliable(scored.where((F.col("label") == true_label) & (F.col("prediction") == predicted))
                          .select("split", key, "label", "prediction"))
    return texts.join(broadcast_if_bounded(hits), key).select(*hits.columns, *[c for c in texts.columns if c != key])


# UD3: user metrics over the scored table, registered by name ---------------

METRICS: dict = {
    "accuracy": accuracy,
    "micro": micro_metrics,
    "adjacent_confusion": adjacent_confusion_rate,
}


def register_metric(name: str, fn) -> None:
    """Register ``fn(scored: DataFrame) -> DataFrame`` under ``name``."""
    METRICS[name] = fn


def compute_metrics(scored: DataFrame, names: list[str] | None = None) -> dict:
    """Run the named metrics; each returns a DataFrame keyed like its input."""
    return {n: METRICS[n](scored) for n in (names or list(METRICS))}
