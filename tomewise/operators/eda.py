"""Corpus statistics: frequencies, shapes, histograms, summaries, box-plot
figures, rank correlation, top-k (AG1-AG11, SL1, PF4, PF6).

Every statistic is an aggregate that Spark combines map-side; dense
histograms are completed by a join with the bin grid (a parameter-sized
table), never by collecting values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomewise.functions.text import contains_phrase
from tomewise.operators.joins import join_once
from tomewise.operators.ranking import global_running_sum, order_statistics
from tomewise.session import reliable


# AG1, AG2, AG3, SL1 ---------------------------------------------------------

def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Frequency of each non-null value (order by ``count desc, value`` when shown)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(name)))


def counts_table(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """``value_counts`` written once with a reliable ``checkpoint()``, for
    statistics that read it in several passes (describe, range histogram):
    the passes read one row per value instead of re-aggregating the rows."""
    return reliable(value_counts(df, col, name))


def most_common(df: DataFrame, col: str, k: int = 100, name: str = "Frequency") -> DataFrame:
    """SL1: the k most frequent values; ``TakeOrderedAndProject``, no global sort."""
    return value_counts(df, col, name).orderBy(F.col(name).desc(), F.col(col)).limit(k)


def shape(df: DataFrame, group_col: str = "book_id", user_col: str = "user_id",
          approx: bool = False) -> DataFrame:
    """AG2 + AG3: rows, distinct groups, distinct users in one pass."""
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.countDistinct(c))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), cd(group_col).alias("n_books"),
                  cd(user_col).alias("n_users"))


# AG4, AG5, AG6 --------------------------------------------------------------

def _bin_grid(spark, lo: float, hi: float, bins: int) -> DataFrame:
    width = (hi - lo) / bins
    return spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("hi"))


def bin_index(v: Column, lo, hi, bins: int) -> Column:
    """Equal-width bin of ``v`` on [lo, hi]; last bin closed, outside -> null."""
    lo_c, hi_c = F.lit(lo) if not isinstance(lo, Column) else lo, F.lit(hi) if not isinstance(hi, Column) else hi
    raw = F.floor((v - lo_c) * F.lit(float(bins)) / (hi_c - lo_c)).cast("int")
    inside = (v >= lo_c) & (v <= hi_c)
    return F.when(inside, F.least(raw, F.lit(bins - 1)))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """AG4/AG5: ``bin, lo, hi, n`` for every bin, empty bins included."""
    counts = (df.select(bin_index(F.col(col).cast("double"), lo, hi, bins).alias("bin"))
                .where(F.col("bin").isNotNull()).groupBy("bin")
                .agg(F.count(F.lit(1)).alias("n")))
    grid = _bin_grid(df.sparkSession, lo, hi, bins)
    return (grid.join(counts, "bin", "left")
             .select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def histogram_over_range(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """AG6: ``bins`` equal bins from min to max (widened by 0.5 if equal; the
    unit interval, all bins empty, if there is no value).

    The range is one small aggregate; the bin grid is derived in Spark from
    it, so no value passes through the driver.
    """
    v = F.col(col).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).head()  # one pass for both ends
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return histogram(df, col, lo, hi, bins)


# AG7 -----------------------------------------------------------------------

QUARTILES = [0.25, 0.5, 0.75]


def _numbers(df: DataFrame, value: Column, *cols) -> DataFrame:
    """``cols`` and ``_v``, the value as a double; null and NaN left out."""
    v = value.cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).select(*cols, v.alias("_v"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear), max; null and NaN are
    left out.  The quartiles are exact at every size: value counts and a
    distributed running sum place the order statistics."""
    d = _numbers(df, F.col(col), F.lit(0).alias("_all"))
    q = order_statistics(d.groupBy("_all", "_v").agg(F.count(F.lit(1)).alias("_n")), "_all", "_v", QUARTILES)
    s = d.agg(F.count(F.lit(1)).alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
              F.min("_v").alias("min"), F.max("_v").alias("max")).withColumn("_all", F.lit(0))
    # one row on either side
    return s.join(q, "_all", "left").select("count", "mean", "std", "min", F.col("q0").alias("q25"),
                                          F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max")


# AG8 -----------------------------------------------------------------------

def value_freq_by_group(df: DataFrame, group_col: str, value_col: str,
                        lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Per group, frequency of each value (optionally within [lo, hi])."""
    d = df
    if lo is not None:
        d = d.where(F.col(value_col) >= lo)
    if hi is not None:
        d = d.where(F.col(value_col) <= hi)
    return d.groupBy(group_col, value_col).agg(F.count(F.lit(1)).alias("n"))


# AG9 -----------------------------------------------------------------------

def boxplot_stats(df: DataFrame, group_col: str, value_col: str, whis: float = 1.5) -> DataFrame:
    """Per group: quartiles, whiskers at ``whis`` IQR, outlier count.

    Rows are counted by (group, value) once, with map-side combine; quartiles
    (exact at every size), whiskers and outliers all come from those counts.
    """
    counts = reliable(_numbers(df, F.col(value_col), group_col).groupBy(group_col, "_v")
                      .agg(F.count(F.lit(1)).alias("_n")))
    stats = order_statistics(counts, group_col, "_v", QUARTILES).select(
        group_col, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    stats = reliable(stats.withColumn("_hi", F.col("q3") + whis * iqr).withColumn("_lo", F.col("q1") - whis * iqr))
    # A value beyond a whisker is exactly a value beyond its fence (the
    # whisker is the most extreme value inside the fence, or the quartile
    # when none lies between), so outliers are counted in the same pass.
    fenced = join_once(counts, stats.select(group_col, "_lo", "_hi"), group_col)
    w = fenced.groupBy(group_col).agg(
        F.max(F.when(F.col("_v") <= F.col("_hi"), F.col("_v"))).alias("_mx"),
        F.min(F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))).alias("_mn"),
        F.coalesce(F.sum(F.when((F.col("_v") > F.col("_hi")) | (F.col("_v") < F.col("_lo")), F.col("_n"))),
                   F.lit(0)).cast("long").alias("n_outliers"))
    return (join_once(stats, w, group_col)
            .withColumn("whisker_hi", F.greatest(F.coalesce("_mx", "q3"), F.col("q3")))
            .withColumn("whisker_lo", F.least(F.coalesce("_mn", "q1"), F.col("q1")))
            .select(group_col, "n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers"))


# AG11 ----------------------------------------------------------------------

def average_ranks(df: DataFrame, col: str) -> DataFrame:
    """``(col, rank)`` per distinct value.

    The rank is the average 1-based position of the value's rows (ties share
    the mean of their positions), computed from value counts and their
    distributed running sum; rows never meet in one task.
    """
    vc = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    cum = global_running_sum(vc, [F.col(col)], "_n", "_cum")
    return cum.select(col, (F.col("_cum") - F.col("_n") + (F.col("_n") + 1) / 2.0).alias("rank"))


def _with_rank(df: DataFrame, col: str, out: str) -> DataFrame:
    # one row per distinct value; a value that many rows share stays splittable
    return join_once(df, average_ranks(df, col).withColumnRenamed("rank", out), col)


def _ranked_together(df: DataFrame, values: list[Column]) -> DataFrame:
    """``_r0, _r1, ...``: the average ranks of every row's values, each in its
    own column; no value may be null."""
    # written once: a row's number must not change between its melted parts
    wide = reliable(df.select(F.array(*[v + 0.0 for v in values]).alias("_v"))).select(
        F.monotonically_increasing_id().alias("_row"), "_v")
    melted = wide.select("_row", F.posexplode("_v").alias("_c", "_x")).select("_row", F.struct("_c", "_x").alias("_cell"))
    counts = melted.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).select("_cell._c", "_cell._x", "_n")
    cum = reliable(global_running_sum(counts, [F.col("_c"), F.col("_x")], "_n", "_cum"))
    before = cum.groupBy("_c").agg(F.min(F.col("_cum") - F.col("_n")).alias("_before"))  # a row per column
    ranks = cum.join(F.broadcast(before), "_c").select(F.struct("_c", "_x").alias("_cell"), (
        F.col("_cum") - F.col("_before") - F.col("_n") + (F.col("_n") + 1) / 2.0).alias("_rank"))
    # a value that many rows share stays splittable
    found = join_once(melted, ranks, "_cell")
    return found.groupBy("_row").agg(*[F.max(F.when(F.col("_cell._c") == i, F.col("_rank"))).alias(f"_r{i}")
                                       for i in range(len(values))])


def _rho(a: str, b: str) -> Column:
    """Pearson's correlation; NaN where a side does not vary."""
    flat = (F.stddev_pop(a) == 0) | (F.stddev_pop(b) == 0)
    return F.when(flat, F.lit(float("nan"))).otherwise(
        F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def spearman(df: DataFrame, a: str, b: str) -> float | None:
    """Spearman's rho of two columns; rows with a null or NaN in either
    dropped; NaN if a column is constant, None without rows."""
    va, vb = F.col(a).cast("double"), F.col(b).cast("double")
    pair = df.select(va.alias("_a"), vb.alias("_b")).where(
        va.isNotNull() & vb.isNotNull() & ~F.isnan(va) & ~F.isnan(vb))
    ranked = _with_rank(_with_rank(pair, "_a", "_ra"), "_b", "_rb")
    return ranked.agg(_rho("_ra", "_rb")).head()[0]


def spearman_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """AG11: Spearman rank correlation for every pair, NaN and null dropped
    pairwise (ranks are taken within each pair's rows).  A constant column has
    no correlation: NaN, on the diagonal, too.

    One aggregate counts the null/NaN values of every column.  Columns with
    none rank the same rows in every pair, so all of them are ranked together:
    their values are melted to (column, value), one distributed order of the
    value counts gives every value its average rank, one join brings the ranks
    to the melted rows, one regroup puts a row's ranks side by side, and all
    pairs come from a single aggregate.  A pair touching a column with missing
    values is ranked on its own rows.  The k x k result is the only thing that
    reaches the driver.
    """
    spark = df.sparkSession
    vals = {c: F.col(c).cast("double") for c in cols}
    real = {c: F.when(~F.isnan(v), v) for c, v in vals.items()}
    facts = df.agg(*[F.count_if(real[c].isNull()).alias(f"_bad{i}") for i, c in enumerate(cols)],
                   *[(F.min(real[c]) < F.max(real[c])).alias(f"_varies{i}") for i, c in enumerate(cols)]).head()
    clean = [c for i, c in enumerate(cols) if facts[f"_bad{i}"] == 0]
    rho: dict = {}
    if len(clean) >= 2:
        ranked = _ranked_together(df, [vals[c] for c in clean])
        pairs = [(i, j) for i in range(len(clean)) for j in range(i + 1, len(clean))]
        got = ranked.agg(*[_rho(f"_r{i}", f"_r{j}").alias(f"_c{i}_{j}") for i, j in pairs]).head()
        for i, j in pairs:
            rho[(clean[i], clean[j])] = got[f"_c{i}_{j}"]
    rows = []
    for i, a in enumerate(cols):
        rows.append((a, a, 1.0 if facts[f"_varies{i}"] else float("nan")))
        for b in cols[i + 1:]:
            r = rho[(a, b)] if (a, b) in rho else spearman(df, a, b)
            rows += [(a, b, r), (b, a, r)]
    return spark.createDataFrame(rows, "var_a string, var_b string, rho double")


# PF4 -----------------------------------------------------------------------

def with_phrase(df: DataFrame, phrase: str, text_col: str = "review_text") -> DataFrame:
    """Rows whose text contains ``phrase`` literally."""
    return df.where(contains_phrase(text_col, phrase))
