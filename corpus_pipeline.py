"""The corpus pipeline: quality rules, line deduplication, SimHash near-dedup,
best-fit packing.  Each stage works on what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewise.llm import line_windows, packing, repetition, simhash
from tomewise.llm.batches import quoted
from tomewise.llm.queries import vocabulary_path
from tomewise.session import remove_dir, scratch_dir


OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with further columns under names that no operator uses."""
    return docs.select(*[F.col(quoted(c)).alias(c if c in OWN else f"_further{i}") for i, c in enumerate(docs.columns)])


def _named(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with their names."""
    return out.select(*[F.col(c if c in OWN else f"_further{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the repetition limits; a null
    text has no words and goes."""
    return _named(repetition.repetition_rules(_apart(docs)).where("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of passages that came earlier; ``n_chars``
    follows the text; no document goes."""
    left = line_windows.remove_repeated_windows(_apart(docs))
    return _named(left.withColumn("n_chars", F.char_length("text").cast("long")), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest id, then of
    the smallest hash of the text.  Rows are one document if id and text are
    equal; of several such rows the one whose columns have the smallest hash
    stays.  Rows without an id are copies of each other, never of a row with an
    id: of them, too, each group keeps one."""
    rows = _apart(docs).withColumn("_row", F.concat_ws(
        ":", F.coalesce(F.sha2("text", 256), F.lit("")), F.col("doc_id").cast("string")))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("_row").alias("row"))
    groups = simhash.near_duplicates(rows.select(key.alias("doc_id"), "text"))
    first = groups.groupBy("component_id", "doc_id.no_id").agg(F.min("doc_id").alias("first")).select(
        F.col("first.row").alias("_row"))
    columns = [c for c in rows.columns if c != "_row"]
    mark = F.xxhash64(F.to_json(F.struct(*[c for c in columns if c not in ("doc_id", "text")])))
    left = rows.join(first, "_row", "left_semi").groupBy("_row").agg(F.min_by(F.struct(*columns), mark).alias("r"))
    return _named(left.select("r.*"), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents left."""
    return packing.pack(docs, vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing)]

# Fingerprints (XXH64) and token ids are beyond SQL; the tests hold the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the
    shared folder, read again by the next, and dropped when that is written."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_dir(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
