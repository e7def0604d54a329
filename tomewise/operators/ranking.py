"""Positions, running sums and order statistics in a total order without a
single-task window, by one path at every size.

``global_positions`` range-partitions and sorts (distributed) and writes the
sorted table with ``checkpoint()``, so every later pass reads the same
partitions in the same order even if an executor is lost.  Each row's
place inside its partition comes from ``monotonically_increasing_id`` (the
partition index sits in the high bits, the row number in the low 33 bits);
a table with one row per partition gives each partition its offset and is
broadcast (its size is the partition count, known before any job runs).
Everything stays in JVM expressions: no Python touches the rows.

``positions_within`` and ``order_statistics`` take a key's offset from that
order, so a hot key is spread over many tasks and no task holds a key's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewise.operators.joins import join_once
from tomewise.session import reliable

_LOW33 = (1 << 33) - 1


def _sorted_tagged(df: DataFrame, order_cols: list) -> tuple[DataFrame, int]:
    """Sorted, checkpointed copy of ``df`` with ``_p`` (partition) and ``_r``
    (row number within the partition), and the number of partitions."""
    ordered = reliable(df.orderBy(*order_cols))
    mid = F.monotonically_increasing_id()
    tagged = ordered.select("*", mid.alias("_mid")).select(
        *df.columns, F.shiftright(F.col("_mid"), 33).cast("int").alias("_p"),
        F.col("_mid").bitwiseAND(F.lit(_LOW33)).alias("_r"))
    return tagged, ordered.rdd.getNumPartitions()


def _partition_offsets(tagged: DataFrame, weight, n_parts: int) -> DataFrame:
    """``_p, _off``: the total ``weight`` of all earlier partitions."""
    per = tagged.groupBy("_p").agg(F.sum(weight).alias("_w"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    off = per.select("_p", F.coalesce(F.sum("_w").over(w), F.lit(0)).cast("long").alias("_off"))
    # ``n_parts`` rows at most: a proven bound, so the broadcast is safe
    return F.broadcast(off) if n_parts <= 1_000_000 else off


def global_positions(df: DataFrame, order_cols: list, name: str = "_pos") -> DataFrame:
    """``df`` plus a 0-based position in the order of ``order_cols`` (total order)."""
    tagged, n_parts = _sorted_tagged(df, order_cols)
    off = _partition_offsets(tagged, F.lit(1), n_parts)
    return (tagged.join(off, "_p")
                  .select(*df.columns, (F.col("_off") + F.col("_r")).alias(name)))


def global_running_sum(df: DataFrame, order_cols: list, value: str, name: str) -> DataFrame:
    """``df`` plus the running sum of ``value`` (inclusive) in a total order.

    Within a partition the sum is a window over that partition's rows only
    (a range partition of the sorted table, so bounded by the sort's split),
    plus the partition's offset.
    """
    tagged, n_parts = _sorted_tagged(df, order_cols)
    off = _partition_offsets(tagged, F.col(value), n_parts)
    w = Window.partitionBy("_p").orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    return (tagged.withColumn("_in", F.sum(value).over(w))
                  .join(off, "_p")
                  .select(*df.columns, (F.col("_off") + F.col("_in")).alias(name)))


def positions_within(df: DataFrame, part_col: str, order_cols: list, name: str = "_pos") -> DataFrame:
    """``df`` plus the 0-based position of each row within its ``part_col``
    (null is a key of its own)."""
    g = global_positions(df, [F.col(part_col)] + list(order_cols), "_gpos")
    first = g.groupBy(part_col).agg(F.min("_gpos").alias("_first"))
    return (join_once(g, first, part_col)
            .select(*df.columns, (F.col("_gpos") - F.col("_first")).alias(name)))


def order_statistics(counts: DataFrame, group_col: str, value_col: str, probs: list[float],
                     n_col: str = "_n") -> DataFrame:
    """Exact quantiles (linear interpolation) per group from value counts.

    ``counts`` has one row per (group, value) with its number of rows.  The
    running sum in the order (group, value) places every value; a quantile
    needs the values at two positions, each the least value whose running sum
    passes it.  Returns ``group_col, n, q0, q1, ...``.
    """
    cum = reliable(global_running_sum(counts.select(group_col, value_col, n_col),
                                      [F.col(group_col), F.col(value_col)], n_col, "_cum"))
    per = cum.groupBy(group_col).agg(F.sum(n_col).alias("n"), F.min(F.col("_cum") - F.col(n_col)).alias("_base"))
    placed = join_once(cum, per, group_col).withColumn("_at", F.col("_cum") - F.col("_base"))
    aggs = [F.max("n").alias("n")]
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("n") - 1)
        for side, pos in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.min(F.when(F.col("_at") > pos, F.col(value_col))).cast("double").alias(f"_{side}{i}"))
    got = placed.groupBy(group_col).agg(*aggs)
    out = [group_col, "n"]
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (h - F.floor(h)) * (hi - lo)).alias(f"q{i}"))
    return got.select(*out)


