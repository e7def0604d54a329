"""Joins whose plan does not depend on luck: broadcast only what is proven
small, and keep a hot key's partition splittable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def broadcast_if_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                         max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows and ``max_bytes``
    bytes (checked on ``limit(max_rows + 1)``), else ``df`` for a shuffle join;
    the result of the join is the same.  Callers pass small derived tables
    (aggregates, filtered keys), so the check reads little."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)])))
    n, b = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).head()
    return F.broadcast(df) if n <= max_rows and (b or 0) <= max_bytes else df


def join_once(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Null-safe join on ``key``, which ``right`` holds at most once, for a
    ``left`` in which one key may hold a large share of the rows.

    The condition compares a hash of the key as well, so Spark deals out both
    sides for this join alone, however they are dealt already, and adaptive
    execution may split a hot key's partition."""
    l = left.withColumn("__join_h", F.xxhash64(key))
    r = right.withColumnRenamed(key, "__join_key").withColumn("__join_g", F.xxhash64("__join_key"))
    on = (F.col("__join_h") == F.col("__join_g")) & F.col(key).eqNullSafe(F.col("__join_key"))
    return l.join(r, on, how).drop("__join_h", "__join_g", "__join_key")
