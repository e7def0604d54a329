"""SP1 under-sampling, SL4 seeded shuffle, and the exact hash-key cut they share.

Random choices are replaced by a seeded key ``md5(seed || ':' || id)``:
the same rows come out on every run and in the DuckDB oracle.

``kth_smallest`` finds, per stratum, the k-th smallest ``(key, tiebreak)``
without ranking whole strata in one task (a class may hold a third of all
rows): a histogram on the first hex digits of the key locates the bucket
holding the k-th row, and only that bucket (about 1/16**digits of the
stratum) is ranked.  The result is one threshold per stratum, applied by a
narrow filter: no join and no shuffle of the rows themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomewise.operators.joins import broadcast_if_bounded, join_once
from tomewise.session import reliable

KEEP_ALL = "all"
KEEP_NONE = "none"


def seeded_key(seed, col) -> Column:
    """Hex md5 of ``'<seed>:<id>'``; equal in Spark and DuckDB."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), c.cast("string")))


@dataclass(frozen=True)
class Threshold:
    key: str | None
    tiebreak: object | None
    mode: str = "cut"  # "cut", KEEP_ALL or KEEP_NONE


def _stratum_match(strata: list[str], values: tuple) -> Column:
    cond = F.lit(True)
    for s, v in zip(strata, values):
        cond = cond & (F.col(s).isNull() if v is None else (F.col(s) == F.lit(v)))
    return cond


def _per_stratum(strata, mapping: dict, default) -> Column:
    """CASE over a bounded set of strata (classes), literal per stratum."""
    if not strata:
        return F.lit(mapping.get((), default))
    expr = None
    for values, v in mapping.items():
        cond = _stratum_match(strata, values)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def bucket_digits(largest_stratum: int, target: int = 50_000, max_digits: int = 5) -> int:
    """Hex digits of the key prefix so that a bucket holds about ``target``
    rows of the largest stratum; at most ``max_digits`` (16**5 buckets), which
    bounds the per-stratum histogram window."""
    need = max(1, -(-int(largest_stratum) // target))
    d = 1
    while 16 ** d < need and d < max_digits:
        d += 1
    return d


def kth_smallest(df: DataFrame, k: dict | int, key: str, tiebreak: str,
                 strata: list[str] | tuple = (), bucket_chars: int | None = None,
                 max_strata: int = 10_000, largest_stratum: int | None = None) -> dict:
    """Per stratum, the k-th smallest ``(key, tiebreak)`` as a ``Threshold``.

    ``k`` is an int for every stratum or a dict ``{stratum tuple: k}``.  The
    strata must be a bounded domain (classes); at most ``max_strata`` rows
    reach the driver.  Two passes over ``df``: the bucket histogram, then the
    boundary buckets only.  The key prefix length is ``bucket_chars``, or
    sized from ``largest_stratum`` (rows of the biggest stratum), else 4.
    """
    if bucket_chars is None:
        bucket_chars = bucket_digits(largest_stratum) if largest_stratum is not None else 4
    strata = list(strata)
    kd = k if isinstance(k, dict) else None
    kk = _per_stratum(strata, kd, 0) if kd is not None else F.lit(int(k))
    bucket = F.substring(F.col(key), 1, bucket_chars)
    hist = df.groupBy(*strata, bucket.alias("_b")).count()
    w = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("_cum", F.sum("count").over(w)).withColumn("_k", kk)
    bounds = (hist.where(F.col("_cum") >= F.col("_k"))
                  .groupBy(*strata)
                  .agg(F.min_by(F.struct(F.col("_b"),
                                         (F.col("_k") - F.col("_cum") + F.col("count")).alias("_need")),
                                F.col("_b")).alias("_s"))
                  .select(*strata, "_s._b", "_s._need")
                  .limit(max_strata + 1).collect())
    if len(bounds) > max_strata:
        raise ValueError(f"more than {max_strata} strata")
    out: dict = {}
    boundary = {}
    for r in bounds:
        sv = tuple(r[s] for s in strata)
        if r["_need"] == 0:
            out[sv] = Threshold(None, None, KEEP_NONE)
        else:
            boundary[sv] = (r["_b"], int(r["_need"]))
    if boundary:
        in_bucket = None
        for sv, (b, _) in boundary.items():
            c = _stratum_match(strata, sv) & (bucket == F.lit(b))
            in_bucket = c if in_bucket is None else (in_bucket | c)
        need = _per_stratum(strata, {sv: n for sv, (_, n) in boundary.items()}, -1)
        rw = Window.partitionBy(*strata).orderBy(F.col(key), F.col(tiebreak))
        picked = (df.where(in_bucket)
                    .select(*strata, key, tiebreak)
                    .withColumn("_rn", F.row_number().over(rw))
                    .where(F.col("_rn") == need)
                    .limit(max_strata + 1).collect())
        for r in picked:
            out[tuple(r[s] for s in strata)] = Threshold(r[key], r[tiebreak])
    return out  # strata absent from the result keep all their rows


def threshold_filter(thresholds: dict, key: str, tiebreak: str,
                     strata: list[str] | tuple = ()) -> Column:
    """Column true for rows at or below their stratum's threshold."""
    strata = list(strata)
    expr = None
    for sv, t in thresholds.items():
        if t.mode == KEEP_NONE:
            keep = F.lit(False)
        else:
            keep = (F.col(key) < F.lit(t.key)) | (
                (F.col(key) == F.lit(t.key)) & (F.col(tiebreak) <= F.lit(t.tiebreak)))
        cond = _stratum_match(strata, sv)
        expr = F.when(cond, keep) if expr is None else expr.when(cond, keep)
    return F.lit(True) if expr is None else expr.otherwise(F.lit(True))


def keep_smallest(df: DataFrame, k: dict | int, key: str, tiebreak: str,
                  strata: list[str] | tuple = (), **kw) -> DataFrame:
    """Rows with the k smallest ``(key, tiebreak)`` in each stratum, exactly."""
    thr = kth_smallest(df, k, key, tiebreak, strata, **kw)
    return df.where(threshold_filter(thr, key, tiebreak, strata))


# So many classes are cut by conditions on the rows, more by a joined table.
MAX_CUT_CLASSES = 32


def cut_table(keyed: DataFrame, k: int, key: str, tiebreak: str, label_col: str, largest: int) -> DataFrame:
    """``label_col, _cut`` for any number of classes: the ``k``-th smallest
    ``(key, tiebreak)`` of each class that has more than ``k`` rows.  A class's
    histogram of key beginnings names the bucket that holds the place, and only
    that bucket is ranked; nothing reaches the driver."""
    bucket = F.substring(F.col(key), 1, bucket_digits(largest))
    w = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    hist = keyed.groupBy(label_col, bucket.alias("_b")).count().withColumn("_cum", F.sum("count").over(w))
    bounds = hist.where(F.col("_cum") >= k).groupBy(label_col).agg(
        F.min_by(F.struct("_b", (k - F.col("_cum") + F.col("count")).alias("need")), "_b").alias("_at")).select(
        F.col(label_col).alias("_of"), "_at._b", "_at.need")
    place = Window.partitionBy("_of").orderBy(key, tiebreak)
    held = keyed.select(F.col(label_col), key, tiebreak, bucket.alias("_in"))
    edge = held.join(broadcast_if_bounded(reliable(bounds)), (F.col(label_col) == F.col("_of")) & (F.col("_in") == F.col("_b")))
    return (edge.withColumn("_rank", F.row_number().over(place)).where(F.col("_rank") == F.col("need"))
                .select(F.col("_of").alias(label_col), F.struct(F.col(key), F.col(tiebreak)).alias("_cut")))


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    """``label_col, count`` of every class, written once."""
    return reliable(df.where(F.col(label_col).isNotNull()).groupBy(label_col).count())


def undersample(df: DataFrame, label_col: str = "rating", seed: int = 42,
                id_col: str = "review_id", target: int | None = None,
                max_cut_classes: int = MAX_CUT_CLASSES) -> DataFrame:
    """SP1: every class cut to the minority size, without replacement.

    Rows are chosen by the seeded key, so the sample is a deterministic
    function of (seed, ids).  ``target`` overrides the minority size.  Up to
    ``max_cut_classes`` classes are cut by one condition each; beyond, the rows
    meet the thresholds in a join, broadcast when they are proven small.  Both
    keep the same rows, and neither shuffles them when the classes are few.
    """
    classes = class_counts(df, label_col)
    n, least, most = classes.agg(F.count(F.lit(1)), F.min("count"), F.max("count")).head()
    if not n:
        return df.where(F.lit(False))
    m = int(least if target is None else target)
    keyed = df.where(F.col(label_col).isNotNull()).withColumn("_key", seeded_key(seed, id_col))
    if n > max_cut_classes:
        cuts = broadcast_if_bounded(reliable(cut_table(keyed, m, "_key", id_col, label_col, most)))
        at = F.struct(F.col("_key"), F.col(id_col))
        kept = join_once(keyed, cuts, label_col, "left").where(F.col("_cut").isNull() | (at <= F.col("_cut")))
        return kept.drop("_key", "_cut") if m > 0 else df.where(F.lit(False))
    counts = {r[label_col]: r["count"] for r in classes.collect()}  # at most max_cut_classes rows
    kept = keep_smallest(keyed, {(c,): m for c in counts}, "_key", id_col, [label_col], largest_stratum=most)
    return kept.drop("_key")


def undersample_approx(df: DataFrame, label_col: str = "rating", seed: int = 42) -> DataFrame:
    """Approximate mode: a Bernoulli draw with fraction m/n per class."""
    classes = class_counts(df, label_col)
    fractions = classes.withColumn("_f", F.min("count").over(Window.partitionBy()) / F.col("count"))  # one row a class
    return (df.join(fractions.drop("count"), label_col).where(F.rand(seed) < F.col("_f")).select(*df.columns))


def seeded_permutation(df: DataFrame, seed: int = 42, id_col: str = "review_id",
                       name: str = "position") -> DataFrame:
    """SL4 on the whole table: every row with its 1-based place in the
    seeded permutation.  The order is a distributed range sort numbered by
    partition offsets (``ranking.global_positions``): no single-task window,
    however large the table."""
    from tomewise.operators.ranking import global_positions
    keyed = df.withColumn("_key", seeded_key(seed, id_col))
    pos = global_positions(keyed, [F.col("_key"), F.col(id_col)], "_pos0")
    return pos.withColumn(name, F.col("_pos0") + 1).drop("_key", "_pos0")


def seeded_head(df: DataFrame, n: int, seed: int = 42, id_col: str = "review_id") -> DataFrame:
    """The first ``n`` rows of the seeded permutation with their position.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: every task
    keeps its own top n, never a global sort.
    """
    top = (df.withColumn("_key", seeded_key(seed, id_col))
             .orderBy("_key", id_col).limit(n))
    w = Window.orderBy("_key", id_col)  # over n rows only
    return top.withColumn("position", F.row_number().over(w)).drop("_key")
