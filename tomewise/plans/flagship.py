"""The flagship query: the whole preparation chain, summarised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tomewise.operators.splits import split_class_mix
from tomewise.plans import prepare as P


def split_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """normalise -> dedup -> balance -> group split -> rows per (split, rating)."""
    return split_class_mix(P.split_processed(spark, sf_dir), "rating")
