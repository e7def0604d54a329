"""SO1: distinct by text, keep the first row (smallest key)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_keep_first(df: DataFrame, text_col: str = "review_text",
                     order_col: str = "review_id", drop_null: bool = True) -> DataFrame:
    """One row per distinct text: the one with the smallest ``order_col``.

    ``dropDuplicates`` would keep an arbitrary row; the window with a literal
    ``= 1`` bound plans as a partial ``WindowGroupLimit`` before the shuffle,
    so every map task already keeps one row per text and a text repeated in
    a third of the corpus crosses the network once per task, not once per row.
    The 64-bit hash leads the window key so the sort compares longs, not long
    strings with shared prefixes.  Null texts never survive; a caller whose
    text is derived (e.g. normalised) should drop nulls on the raw column and
    pass ``drop_null=False``, or the null check on the derived column is
    pushed down to the scan and evaluates the derivation there a second time.
    """
    w = Window.partitionBy(F.xxhash64(text_col), F.col(text_col)).orderBy(F.col(order_col))
    d = df.where(F.col(text_col).isNotNull()) if drop_null else df
    return (d.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))
