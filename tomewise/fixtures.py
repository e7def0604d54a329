"""Views over the driver tables that stand in for the review corpus.

The same expressions are written in SQL in ``tomewise.oracle`` so that Spark
and DuckDB see identical rows.  Each view is a projection of one parquet
scan: Catalyst prunes the columns a query does not touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_row_key(df: DataFrame, cols: list[str], name: str = "review_id") -> DataFrame:
    """PF8 for keyless input: a stable 64-bit key from the row content and,
    for rows with equal content, their number among them.

    Unlike a positional index it does not depend on partitioning or order,
    so it survives re-reads and task retries.  Equal rows are numbered by the
    distributed order of the contents' hash, so a content that many rows share
    is spread over many tasks; only rows that repeat are ordered.
    """
    from tomewise.operators.joins import join_once
    from tomewise.operators.ranking import positions_within
    keyed = df.withColumn("_content", F.xxhash64(*cols))
    again = keyed.groupBy("_content").agg(F.count(F.lit(1)).alias("_same")).where("_same > 1")
    marked = join_once(keyed, again, "_content", "left")
    single = marked.where(F.col("_same").isNull()).withColumn("_nth", F.lit(0).cast("long"))
    several = positions_within(marked.where(F.col("_same").isNotNull()), "_content", [F.col(c) for c in cols], "_nth")
    return (single.unionByName(several)
            .withColumn(name, F.when(F.col("_nth") == 0, F.col("_content")).otherwise(F.xxhash64("_content", "_nth")))
            .drop("_content", "_same", "_nth"))


def rating_from_chars(n_chars: Column) -> Column:
    """Rating 0..5 skewed toward high values, as in the reference corpus."""
    m = n_chars % 36
    return (F.when(m < 1, 0).when(m < 4, 1).when(m < 9, 2).when(m < 16, 3)
            .when(m < 25, 4).otherwise(5)).cast("int")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_id, book_id, user_id, review_text, rating`` from ``documents``.

    ``book_id`` groups grow with the id, so group sizes are skewed; some
    reviews have no user, some no book.
    """
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("review_id"),
        F.when(F.col("doc_id") % 53 != 52, F.floor(F.sqrt(F.col("doc_id") * F.lit(16.0))).cast("bigint"))
         .alias("book_id"),
        F.when(F.col("n_chars") % 41 != 0, F.concat(
            F.col("source"), F.lit("-"), (F.col("n_chars") % 13).cast("string"))).alias("user_id"),
        F.col("text").alias("review_text"),
        rating_from_chars(F.col("n_chars")).alias("rating"),
    )


def split_of(key: Column) -> Column:
    return (F.when(key % 5 == 0, "test").when(key % 5 == 1, "valid").otherwise("train"))


N_CLASSES = 6


def class_scores(embedding: Column, model: int = 0) -> Column:
    """Six class scores from the whole vector: class c of model 0 sums the
    elements c, c + 6, c + 12, ...; model 1 takes them from the far end."""
    def score(c: int) -> Column:
        i = F.sequence(F.lit(c), F.greatest(F.size(embedding) - 1, F.lit(c)), F.lit(N_CLASSES))
        x = F.transform(i, lambda k: F.get(embedding, k if model == 0 else F.size(embedding) - 1 - k))
        return F.aggregate(x, F.lit(0.0), lambda a, e: a + F.coalesce(e.cast("double"), F.lit(0.0)))

    return F.array(*[score(c) for c in range(N_CLASSES)])


def logits(spark: SparkSession, sf_dir: str, model: int = 0) -> DataFrame:
    """``review_id, split, label, logits`` from ``embeddings``; the label is
    folded to the six classes."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("review_id"),
        split_of(F.col("vec_id")).alias("split"),
        (F.col("label") % N_CLASSES).cast("int").alias("label"),
        class_scores(F.col("embedding"), model).alias("logits"),
    )


def dialogue_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second corpus: conversation turns grouped by conversation, class = role.

    The row key packs ``(conv_id, turn)`` into one bigint (turn in the low 32
    bits), distinct for any turn count below 2**32."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        (F.col("conv_id").cast("bigint") * F.lit(1 << 32) + F.col("turn")).alias("review_id"),
        F.col("conv_id").alias("book_id"),
        F.col("turn"),
        F.col("role"),
        F.col("text").alias("review_text"),
    )


def events_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("user_id", "event_type", "value")
