"""ST1: score arriving reviews with each model (Structured Streaming).

``readStream`` over a directory where review files land, the same
normalisation as the batch path, every fitted model, and an append-only
Parquet sink.  The scorer keeps no state between batches, so it needs no
watermark; exactly-once comes from the file sink and its checkpoint, or from
batches that are committed by one atomic move (``sources.commits``).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tomewise.functions.text import normalise
from tomewise.operators.bayes import NaiveBayes
from tomewise.operators.scoring import score_models
from tomewise.sources import commits

ARRIVAL_SCHEMA = T.StructType([
    T.StructField("review_id", T.LongType()),
    T.StructField("review_text", T.StringType()),
])


SCORE_SCHEMA = T.StructType([
    T.StructField("review_id", T.LongType()), T.StructField("model_name", T.StringType()),
    T.StructField("label", T.IntegerType()), T.StructField("score", T.DoubleType()),
    T.StructField("batch", T.IntegerType()),
])


def _arriving(spark: SparkSession, source_dir: str, schema: T.StructType,
              max_files_per_trigger: int | None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir).withColumn("review_text", normalise("review_text"))


def scored_stream(spark: SparkSession, source_dir: str, models: dict[str, PipelineModel],
                  schema: T.StructType = ARRIVAL_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """The streaming DataFrame ``review_id, model_name, label, score``."""
    return score_models(models, _arriving(spark, source_dir, schema, max_files_per_trigger), "review_id")


def start_scorer(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_location: str,
                 models: dict[str, PipelineModel | NaiveBayes], available_now: bool = True,
                 processing_time: str | None = None, max_files_per_trigger: int | None = 1000) -> StreamingQuery:
    """Start the scorer; ``available_now`` drains what has landed, then stops.
    A batch takes at most ``max_files_per_trigger`` files, so a backlog is
    worked off in batches of bounded size.

    Fitted pipelines score row by row in the stream itself, into the file
    sink.  Naive Bayes models join and aggregate, so each micro-batch is scored
    as a batch and committed under its number (``commit_batch``).
    """
    if all(isinstance(m, PipelineModel) for m in models.values()):
        out = scored_stream(spark, source_dir, models, max_files_per_trigger=max_files_per_trigger)
        w = out.writeStream.format("parquet").outputMode("append")
        sink = {"path": sink_dir}
    else:
        arriving = _arriving(spark, source_dir, ARRIVAL_SCHEMA, max_files_per_trigger)

        def write(batch: DataFrame, number: int) -> None:
            # the query's id outlives its runs: it is kept in the checkpoint
            query = json.loads(commits.read_text(spark, f"{checkpoint_location}/metadata"))["id"]
            commit_batch(lambda: score_each(models, batch), spark, sink_dir, query, number)
        w, sink = arriving.writeStream.foreachBatch(write), {}
    w = w.option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(**sink)


_QUERY = "_query.json"


class ForeignBatch(RuntimeError):
    pass


def commit_batch(scored: Callable[[], DataFrame], spark: SparkSession, sink_dir: str, query: str, number: int) -> bool:
    """Write a batch so that it appears whole or not at all, and once.

    The rows go to a hidden folder that one atomic move turns into
    ``batch=<number>``; a reader lists committed batches only, however far the
    others are.  A batch that runs again finds its commit, computes nothing and
    returns False; a batch of that number by another query is an error.
    """
    target = f"{sink_dir}/batch={number}"
    done = commits.exists(spark, target)
    if not done:
        staged = commits.stage(spark, sink_dir)
        try:
            scored().write.parquet(staged)
            commits.write_text(spark, f"{staged}/{_QUERY}", json.dumps({"query": query, "batch": number}))
            if commits.commit(spark, staged, target):
                return True
        except BaseException:
            commits.remove(spark, staged)
            raise
        commits.remove(spark, staged)
    owner = json.loads(commits.read_text(spark, f"{target}/{_QUERY}"))["query"]
    if owner != query:
        raise ForeignBatch(f"batch {number} in {sink_dir} was committed by query {owner}; give each query a sink of its own")
    return False


def read_scores(spark: SparkSession, sink_dir: str) -> DataFrame:
    """``review_id, model_name, label, score, batch`` of the committed batches."""
    return spark.read.schema(SCORE_SCHEMA).parquet(sink_dir)


def score_each(models: dict[str, PipelineModel | NaiveBayes], df: DataFrame, key: str = "review_id") -> DataFrame:
    """``key, model_name, label, score`` of models of either kind."""
    parts = [m.score(df, [key]).select(key, F.lit(name).alias("model_name"), F.col("prediction").alias("label"),
                                       F.col("confidence").alias("score"))
             for name, m in models.items() if isinstance(m, NaiveBayes)]
    if fitted := {n: m for n, m in models.items() if isinstance(m, PipelineModel)}:
        parts.append(score_models(fitted, df, key))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def batch_equivalent(df: DataFrame, models: dict[str, PipelineModel | NaiveBayes]) -> DataFrame:
    """The same scoring as a batch job (stream = batch check)."""
    return score_each(models, df.withColumn("review_text", normalise("review_text")))


def land(df: DataFrame, landing_dir: str, n_files: int | None = None) -> None:
    """Drop a batch of arriving reviews as new files in the landing folder: in
    the input's partitions, or in ``n_files`` files."""
    d = df.select("review_id", "review_text")
    (d if n_files is None else d.repartition(n_files, F.col("review_id"))).write.mode("append").parquet(landing_dir)
