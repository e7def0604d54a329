"""Leakage-free train/valid/test splits: no group (book) in two splits.

SP2 group shuffle split (exact and hash modes), SP3 stratified group folds
(dealt and batched-greedy), SP4 active-user restriction, SP5/AG10 reports,
SO3 leakage check.  Every split is a ``split`` column on the rows; the
three frames of the original become one partitionable table.

Rows without a group belong to no group that a split could leak: in every
mode they are ``train`` rows, and they count for no fold.  A null stratum is a
stratum of its own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.operators.joins import join_once
from tomewise.operators.ranking import global_positions, positions_within
from tomewise.operators.sampling import kth_smallest, seeded_key, threshold_filter
from tomewise.session import reliable as _reliable


# SP2, exact ----------------------------------------------------------------

def _first_fraction(groups: DataFrame, n_groups: int, frac: float, key: str,
                    group_col: str) -> Column:
    """Predicate: group among the floor(frac*G) smallest keys."""
    n_keep = math.floor(frac * n_groups)
    thr = kth_smallest(groups, n_keep, key, group_col, largest_stratum=n_groups)
    return threshold_filter(thr, key, group_col)


def group_split_exact(df: DataFrame, group_col: str = "book_id",
                      train_size: float = 0.8, valid_train_size: float = 0.75,
                      seeds: tuple[int, int] = (42, 43)) -> DataFrame:
    """SP2: floor(0.8*G) groups to train+valid, the rest to test; then
    floor(0.75*G1) of those to train, the rest to valid.

    Groups are ranked by a seeded key.  Only the distinct groups are
    touched to find the two cut-off keys; rows are then labelled by
    comparing their own group key with the cut-offs, so the rows are never
    joined or shuffled.
    """
    k1, k2 = "_gk1", "_gk2"
    # The distinct groups feed five small passes (count, two histograms, two
    # boundary buckets): written once to the checkpoint folder instead of
    # re-aggregating the rows each time.
    groups = _reliable(df.where(F.col(group_col).isNotNull()).select(group_col).distinct()
                         .withColumn(k1, seeded_key(seeds[0], group_col)))
    n_groups = groups.count()
    in_first = _first_fraction(groups, n_groups, train_size, k1, group_col)
    n_first = math.floor(train_size * n_groups)
    g1 = groups.where(in_first).withColumn(k2, seeded_key(seeds[1], group_col))
    in_train = _first_fraction(g1, n_first, valid_train_size, k2, group_col)
    return (df.withColumn(k1, seeded_key(seeds[0], group_col))
              .withColumn(k2, seeded_key(seeds[1], group_col))
              .withColumn("split", F.when(F.col(group_col).isNull(), "train").when(~in_first, "test")
                                    .when(in_train, "train").otherwise("valid"))
              .drop(k1, k2))


# SP2, hash mode ------------------------------------------------------------

def hash_cut(frac: float) -> str:
    """Eight-hex-digit threshold below which a fraction ``frac`` of keys fall."""
    return format(min(math.floor(frac * 2 ** 32), 2 ** 32 - 1), "08x")


def group_split_hash(df: DataFrame, group_col: str = "book_id",
                     train_size: float = 0.8, valid_train_size: float = 0.75,
                     seeds: tuple[int, int] = (42, 43)) -> DataFrame:
    """SP2 without any ranking: a group's split depends on its key only, so a
    group never moves when data is added, and the plan is a projection."""
    h1 = F.substring(seeded_key(seeds[0], group_col), 1, 8)
    h2 = F.substring(seeded_key(seeds[1], group_col), 1, 8)
    return df.withColumn("split", F.when(F.col(group_col).isNull(), "train")
                                   .when(h1 >= F.lit(hash_cut(train_size)), "test")
                                   .when(h2 >= F.lit(hash_cut(valid_train_size)), "valid")
                                   .otherwise("train"))


# SP3, dealt variant (SQL-checkable) ----------------------------------------

def _hex8_to_long(c: Column) -> Column:
    return F.conv(F.substring(c, 1, 8), 16, 10).cast("bigint")


def group_stratum_counts(df: DataFrame, group_col: str = "book_id",
                         stratum_col: str = "user_id") -> DataFrame:
    """``group_col, stratum_col, _m``: rows per (group, stratum); rows without
    a group are left out."""
    return df.where(F.col(group_col).isNotNull()).groupBy(group_col, stratum_col).agg(F.count(F.lit(1)).alias("_m"))


def deal_groups(df: DataFrame, n_folds: int, group_col: str = "book_id",
                stratum_col: str = "user_id", seed: int = 42,
                counts: DataFrame | None = None) -> DataFrame:
    """Fold of each group: ``group_col, stratum, n_rows, fold``.

    A group's stratum is its most frequent stratum value (ties: smallest
    value).  Within a stratum, groups are dealt round-robin by (rows desc,
    seeded key), starting at a seeded per-stratum offset.  Works on the
    group table (one row per group), never on rows.  ``counts`` (from
    ``group_stratum_counts``) skips the pass over the rows.
    """
    m = counts if counts is not None else group_stratum_counts(df, group_col, stratum_col)
    g = m.groupBy(group_col).agg(
        F.sum("_m").alias("n_rows"),
        F.min_by(F.col(stratum_col), F.struct(-F.col("_m"), F.col(stratum_col))).alias("stratum"))
    # place within the stratum from the distributed order of (stratum, ...),
    # so a hot stratum is spread over many tasks
    order = [F.col("n_rows").desc(), seeded_key(seed, group_col), F.col(group_col)]
    offset = _hex8_to_long(seeded_key(seed, F.coalesce(F.col("stratum").cast("string"), F.lit(""))))
    return (positions_within(g, "stratum", order, "_pos")
            .withColumn("fold", ((F.col("_pos") + offset) % n_folds).cast("int"))
            .drop("_pos"))


def stratified_deal_split(df: DataFrame, group_col: str = "book_id",
                          stratum_col: str = "user_id", n_test: int = 5,
                          n_valid: int = 4, seed: int = 42) -> DataFrame:
    """SP3 (dealt): fold 0 of 5 is test, fold 0 of 4 over the rest is valid.

    The rows are aggregated once into (group, stratum) counts, written with
    ``checkpoint()``; the second dealing reads those counts restricted to
    the non-test groups instead of re-reading and re-aggregating the rows.
    """
    counts = _reliable(group_stratum_counts(df, group_col, stratum_col))
    f1 = deal_groups(df, n_test, group_col, stratum_col, seed, counts=counts).select(
        group_col, (F.col("fold") == 0).alias("_test"))
    rest = counts.join(f1.where(~F.col("_test")).select(group_col), group_col, "left_semi")
    f2 = deal_groups(df, n_valid, group_col, stratum_col, seed + 1, counts=rest).select(
        group_col, (F.col("fold") == 0).alias("_valid"))
    decided = f1.join(f2, group_col, "left")
    # one row per group; a book may hold a large share of the rows
    return (join_once(df, decided, group_col, "left")
              .withColumn("split", F.when(F.col("_test"), "test")
                                    .when(F.col("_valid"), "valid").otherwise("train"))
              .drop("_test", "_valid"))


# SP3, greedy ------------------------------------------------------------------

# A stratum with at least 1/HEAD_SHARE of all rows stands for itself, smaller ones
# are merged into HEAD_SHARE hashed ones: a group meets at most twice as many.
HEAD_SHARE = 2_000
# Groups that are priced one after another, in one task.
BLOCK_GROUPS = 1_024
# How often a block's groups are priced again, each against all others.
PRICED_AGAIN = 3
# A fold may exceed its even share of the rows by this factor.
MAX_OVER = 1.02


def _place_block(block: pa.Table, n_folds: int, rows: list[float], n_blocks: int) -> tuple[list[int], list[int]]:
    """Places (first rows) and folds of a block's groups, priced one after another.

    ``block`` has a row per group and stratum, the groups in order (``_idx``):
    the group's rows ``_n``, the share ``_x`` of the stratum's rows that it
    holds and the shares ``_f`` of the stratum in each fold before this round.
    A group takes the fold whose squared stratum shares grow least, ties to the
    fold with the fewest rows, among the folds within their share of the rows;
    if none is, the fold with the fewest rows.  The blocks of a round work side
    by side and alike, so each counts its own picks ``n_blocks`` times.
    """
    index, n, x = (block.column(c).to_numpy() for c in ("_idx", "_n", "_x"))
    _, first, stratum = np.unique(block.column("_k").to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
    known = block.column("_f").take(pa.array(first)).to_pylist()
    shares = np.array([f or [0.0] * n_folds for f in known])
    begin = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    held = np.array(rows, np.float64)
    room = MAX_OVER * (held.sum() + n_blocks * n[begin].sum()) / n_folds
    folds = np.full(len(begin), -1)
    ends = [*begin[1:].tolist(), len(index)]
    for _ in range(1 + PRICED_AGAIN):
        for g, (a, b) in enumerate(zip(begin.tolist(), ends)):
            at, own, more = stratum[a:b], n_blocks * x[a:b], n_blocks * float(n[a])
            if (fold := folds[g]) >= 0:  # out of its fold, as if it came last
                shares[at, fold] -= own
                held[fold] -= more
            cost = np.round(own @ shares[at], 9)
            open_ = held + more <= room
            fold = int(np.lexsort((held, cost, ~open_))[0]) if open_.any() else int(np.argmin(held))
            shares[at, fold] += own
            held[fold] += more
            folds[g] = fold
    return begin.tolist(), folds.tolist()


def _placing(n_folds: int, rows: tuple[float, ...], n_blocks: int, group_col: str):
    def place(block):
        block = block.sort_by([("_idx", "ascending"), ("_k", "ascending")])
        at, folds = _place_block(block, n_folds, rows, n_blocks)
        return pa.table([block.column(group_col).take(pa.array(at)), pa.array(folds, pa.int32())],
                        names=[group_col, "fold"])

    return place


def stratified_group_folds(df: DataFrame, n_folds: int = 5, group_col: str = "book_id",
                           stratum_col: str = "user_id", seed: int = 42, head_share: int = HEAD_SHARE,
                           counts: DataFrame | None = None, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """SP3 (balanced): ``group_col, fold`` with groups intact, the folds of
    nearly equal size and every stratum spread as evenly as possible.

    Batched greedy, by one algorithm at every size.  Groups are ordered by
    (rows desc, seeded key) and cut into rounds of doubling size: the first
    ``block_groups``, then as many as all rounds before.  A round is dealt into
    blocks of at most ``block_groups`` groups, each a cross-section of it.
    Every block is priced in Spark against the running (fold, stratum) table
    of the rounds before and picks by price under a cap on the fold's rows
    (``_place_block``); then the picks enter the table, which is written with
    ``checkpoint()``.  The largest groups, which decide the balance, come first
    and see each other; later groups are small against the table.  The rounds
    grow with the logarithm of the groups.  Strata of less than
    1/``head_share`` of the rows are merged into ``head_share`` hashed ones, so
    the running table and a group's strata are bounded; only group-level tables
    are touched, and the driver sees one number per fold and round.
    """
    if counts is None:
        counts = group_stratum_counts(df, group_col, stratum_col)
    m = _reliable(counts.where(F.col(group_col).isNotNull()).select(
        F.col(group_col), F.col(stratum_col).cast("string").alias("_s"), F.col("_m")))
    total = m.agg(F.sum("_m")).head()[0] or 0
    if not total:
        return m.select(group_col, F.lit(0).alias("fold"))
    strata = (m.where(F.col("_s").isNotNull()).groupBy("_s").agg(F.sum("_m").alias("_t"))
               .where(F.col("_t") * head_share >= total).select(F.col("_s").alias("_large_s")))
    # at most head_share rows by its definition
    named = m.join(F.broadcast(strata), F.col("_s") == F.col("_large_s"), "left").select(
        group_col, "_m", F.when(F.col("_s").isNull(), "null").when(F.col("_large_s").isNotNull(), F.concat(F.lit("s"), "_s"))
        .otherwise(F.concat(F.lit("h"), F.pmod(F.xxhash64("_s"), F.lit(head_share)))).alias("_k"))
    merged = named.groupBy("_k").agg(F.sum("_m").alias("_t"))  # at most 2 head_share + 1 rows
    groups = m.groupBy(group_col).agg(F.sum("_m").alias("_n"))
    placed = global_positions(groups, [F.col("_n").desc(), seeded_key(seed, group_col), F.col(group_col)], "_idx")
    cells = _reliable(named.groupBy(group_col, "_k").agg(F.sum("_m").alias("_m")).join(F.broadcast(merged), "_k")
                           .join(placed, group_col)
                           .select(group_col, "_k", "_n", "_idx", (F.col("_m") / F.col("_t")).alias("_x")))
    n_groups = cells.agg(F.max("_idx")).head()[0] + 1
    out = T.StructType([df.schema[group_col], T.StructField("fold", T.IntegerType(), False)])
    rows, state, done, begin = [0.0] * n_folds, None, None, 0
    while begin < n_groups:
        size = max(begin, block_groups)
        n_blocks = math.ceil(min(size, n_groups - begin) / block_groups)
        part = cells.where(F.col("_idx").between(begin, begin + size - 1)).withColumn(
            "_b", (F.col("_idx") % n_blocks).cast("int"))
        part = (part.withColumn("_f", F.lit(None).cast("array<double>")) if state is None
                else part.join(F.broadcast(state), "_k", "left"))  # as many rows as strata
        picks = _reliable(part.groupBy("_b").applyInArrow(_placing(n_folds, tuple(rows), n_blocks, group_col), out))
        done = picks if done is None else done.unionByName(picks)
        begin += size
        if begin < n_groups:
            chosen = part.drop("_f", "_b").join(picks, group_col)
            grown = chosen.groupBy("_k").agg(F.array(*[
                F.sum(F.when(F.col("fold") == f, F.col("_x")).otherwise(0.0)) for f in range(n_folds)]).alias("_f"))
            if state is not None:
                grown = state.unionByName(grown).groupBy("_k").agg(F.array(*[
                    F.sum(F.col("_f")[f]) for f in range(n_folds)]).alias("_f"))
            state = _reliable(grown)
            held = picks.join(groups, group_col).groupBy("fold").agg(F.sum("_n").alias("n")).collect()  # a row per fold
            for r in held:
                rows[r["fold"]] += r["n"]
    return done


def stratified_greedy_split(df: DataFrame, group_col: str = "book_id",
                            stratum_col: str = "user_id", seed: int = 42) -> DataFrame:
    """SP3 as the original uses it: fold 0 of 5 is test, fold 0 of 4 over the
    remaining groups is valid, the rest train.  The rows are aggregated once;
    the second fold assignment reads the (group, stratum) counts of the
    remaining groups."""
    counts = _reliable(group_stratum_counts(df, group_col, stratum_col))
    f1 = _reliable(stratified_group_folds(df, 5, group_col, stratum_col, seed, counts=counts))
    test_groups = f1.where(F.col("fold") == 0).select(group_col)
    rest = counts.join(test_groups, group_col, "left_anti")
    f2 = stratified_group_folds(df, 4, group_col, stratum_col, seed + 1, counts=rest)
    valid_groups = f2.where(F.col("fold") == 0).select(group_col)
    # test and valid groups are disjoint: one small (group, split) table, so
    # the rows are joined once
    decided = (test_groups.withColumn("_s", F.lit("test"))
               .unionByName(valid_groups.withColumn("_s", F.lit("valid"))))
    return (join_once(df, decided, group_col, "left")
              .withColumn("split", F.coalesce(F.col("_s"), F.lit("train")))
              .drop("_s"))


# SP4 -----------------------------------------------------------------------

def active_users(df: DataFrame, user_col: str = "user_id", min_reviews: int = 5) -> DataFrame:
    """Users with at least ``min_reviews`` rows (HAVING)."""
    return (df.groupBy(user_col).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_reviews).select(user_col))


def restrict_to_active(df: DataFrame, user_col: str = "user_id", min_reviews: int = 5) -> DataFrame:
    """J1: left-semi join on the active-user set (rows without a user drop out)."""
    known = df.where(F.col(user_col).isNotNull())
    return join_once(known, active_users(known, user_col, min_reviews), user_col, "left_semi")


def restrict_to_casual(df: DataFrame, user_col: str = "user_id", min_reviews: int = 5) -> DataFrame:
    """J2: left-anti join on the active-user set; rows without a user are
    nobody's reviews and drop out."""
    known = df.where(F.col(user_col).isNotNull())
    return join_once(known, active_users(known, user_col, min_reviews), user_col, "left_anti")


def active_user_dealt_split(df: DataFrame, group_col: str = "book_id",
                            user_col: str = "user_id", min_reviews: int = 5,
                            n_folds: int = 5, seed: int = 42) -> DataFrame:
    """SP4: active users only, then fold 0 of a dealt k-fold is test.

    The rows are aggregated once into (group, user) counts (written with
    ``checkpoint()``); the active users, the dealing and the per-(group,
    user) labels all come from that table, and the rows meet it in a single
    join that both keeps active users' rows and attaches their split.
    """
    counts = _reliable(df.groupBy(group_col, user_col).agg(F.count(F.lit(1)).alias("_m")))
    active = (counts.groupBy(user_col).agg(F.sum("_m").alias("_n"))
                    .where(F.col("_n") >= min_reviews).select(user_col))
    act = counts.join(active, user_col, "left_semi")
    folds = deal_groups(df, n_folds, group_col, user_col, seed,
                        counts=act.where(F.col(group_col).isNotNull())).select(group_col, "fold")
    # a row with no group keeps a null fold (train), as in a join on the group
    labels = act.select(group_col, user_col).join(folds, group_col, "left")
    l = labels.select(F.col(group_col).alias("_g"), F.col(user_col).alias("_u"), "fold")
    on = F.col(group_col).eqNullSafe(F.col("_g")) & (F.col(user_col) == F.col("_u"))
    return (df.join(l, on, "inner")
              .withColumn("split", F.when(F.col("fold") == 0, "test").otherwise("train"))
              .drop("_g", "_u", "fold"))


# SP5, AG10, SO3 ------------------------------------------------------------

def split_proportions(df: DataFrame, group_col: str = "book_id") -> DataFrame:
    """AG10: rows and groups per split and their shares of the whole."""
    per = df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.countDistinct(group_col).alias("n_groups"))
    w = Window.partitionBy()  # over the (at most three) split rows
    return (per.withColumn("row_share", F.col("n_rows") / F.sum("n_rows").over(w))
               .withColumn("group_share", F.col("n_groups") / F.sum("n_groups").over(w)))


def split_class_mix(df: DataFrame, label_col: str = "rating") -> DataFrame:
    """SP5: class counts per split and each class's share of its split."""
    per = df.groupBy("split", label_col).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy("split")
    return per.withColumn("share", F.col("n_rows") / F.sum("n_rows").over(w))


def split_leakage(df: DataFrame, group_col: str = "book_id") -> DataFrame:
    """SO3: groups found in more than one split (empty when leak-free)."""
    return (df.where(F.col(group_col).isNotNull()).groupBy(group_col).agg(F.countDistinct("split").alias("n_splits"))
              .where(F.col("n_splits") > 1))
