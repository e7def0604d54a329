"""Exact seeded sampling and leakage-free splits: brute force and contracts."""

import hashlib
import math
import random

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomewise.operators import sampling as SA
from tomewise.operators import splits as S


def md5key(seed, v):
    return hashlib.md5(f"{seed}:{v}".encode()).hexdigest()


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(0, 70), st.integers(1, 3))
def test_kth_smallest_equals_brute_force(spark, classes, k, digits):
    rows = [(i, c) for i, c in enumerate(classes)]
    df = spark.createDataFrame(rows, "id long, c int").withColumn("key", SA.seeded_key(5, "id"))
    kept = SA.keep_smallest(df, k, "key", "id", ["c"], bucket_chars=digits)
    got = sorted(r.id for r in kept.collect())
    exp = []
    for c in set(classes):
        ids = sorted((md5key(5, i), i) for i, cc in rows if cc == c)
        exp += [i for _, i in ids[:k]]
    assert got == sorted(exp)


def test_undersample_equal_classes_subset_and_repeatable(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([0, 0, 0, 1, 1, 2])) for i in range(400)]
    df = spark.createDataFrame(rows, "review_id long, rating int")
    a = SA.undersample(df, "rating", seed=42)
    b = SA.undersample(df, "rating", seed=42)
    c = SA.undersample(df, "rating", seed=43)
    counts = {r.rating: r["count"] for r in a.groupBy("rating").count().collect()}
    m = min(sum(1 for _, r in rows if r == k) for k in (0, 1, 2))
    assert set(counts.values()) == {m}
    ids_a = sorted(r.review_id for r in a.collect())
    assert ids_a == sorted(r.review_id for r in b.collect())
    assert ids_a != sorted(r.review_id for r in c.collect())
    assert set(ids_a) <= {i for i, _ in rows}
    # same rows as a brute-force ranking by the seeded key
    exp = []
    for k in (0, 1, 2):
        ids = sorted((md5key(42, i), i) for i, r in rows if r == k)
        exp += [i for _, i in ids[:m]]
    assert ids_a == sorted(exp)


def test_undersample_plan_has_no_row_window(spark):
    df = spark.range(1000).select(F.col("id").alias("review_id"), (F.col("id") % 3).cast("int").alias("rating"))
    plan = SA.undersample(df, "rating")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def _groups_df(spark, n_rows=600, n_groups=80, n_users=12, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_rows):
        g = int(n_groups * rnd.random() ** 2)  # skewed group sizes
        rows.append((i, g, f"u{rnd.randrange(n_users)}", rnd.randrange(6)))
    return spark.createDataFrame(rows, "review_id long, book_id long, user_id string, rating int")


def _leak_free(df):
    return df.groupBy("book_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


def test_group_split_exact_counts_and_no_leakage(spark):
    df = _groups_df(spark)
    s = S.group_split_exact(df)
    assert _leak_free(s)
    per = {r.split: r.n for r in s.groupBy("split").agg(F.countDistinct("book_id").alias("n")).collect()}
    G = df.select("book_id").distinct().count()
    n1 = math.floor(0.8 * G)
    assert per["train"] + per["valid"] == n1
    assert per["train"] == math.floor(0.75 * n1)
    assert per["test"] == G - n1


def test_group_split_hash_stable_when_data_grows(spark):
    df = _groups_df(spark)
    more = df.unionByName(_groups_df(spark, 300, 200, seed=9).withColumn("review_id", F.col("review_id") + 10_000))
    a = {r.book_id: r.split for r in S.group_split_hash(df).select("book_id", "split").distinct().collect()}
    b = {r.book_id: r.split for r in S.group_split_hash(more).select("book_id", "split").distinct().collect()}
    assert all(b[g] == s for g, s in a.items())
    assert _leak_free(S.group_split_hash(more))


def test_dealt_split_no_leakage(spark):
    s = S.stratified_deal_split(_groups_df(spark))
    assert _leak_free(s)
    assert {r.split for r in s.select("split").distinct().collect()} == {"train", "valid", "test"}


def _deviation(rows, n_folds):
    """Average over strata of |share of the stratum in a fold - 1/k|."""
    from collections import Counter, defaultdict
    tot = Counter(u for u, _ in rows)
    per = defaultdict(Counter)
    for u, f in rows:
        per[u][f] += 1
    devs = [abs(per[u][f] / tot[u] - 1 / n_folds) for u in tot for f in range(n_folds)]
    return sum(devs) / len(devs)


def _check_folds(df, folds, k, n_rows):
    assert folds.count() == df.where("book_id is not null").select("book_id").distinct().count()
    assert folds.groupBy("book_id").count().where("count > 1").count() == 0
    j = df.join(folds, "book_id")
    assert j.count() == n_rows
    shares = [r["count"] / n_rows for r in j.groupBy("fold").count().collect()]
    assert len(shares) == k
    return j, shares


def test_greedy_folds_contract(spark):
    df = _groups_df(spark, 1200, 150, 15)
    folds = S.stratified_group_folds(df, 5)
    j, shares = _check_folds(df, folds, 5, 1200)
    assert all(abs(s - 0.2) <= 0.02 for s in shares)
    dev = _deviation([(r.user_id, r.fold) for r in j.select("user_id", "fold").collect()], 5)
    # random assignment of the same groups
    rnd = random.Random(0)
    rf = {r.book_id: rnd.randrange(5) for r in folds.select("book_id").collect()}
    rdev = _deviation([(r.user_id, rf[r.book_id]) for r in df.select("user_id", "book_id").collect()], 5)
    assert dev < rdev


def test_greedy_folds_dealt_groups_keep_the_balance(spark):
    # only groups of at least 1/60 of the rows are placed one by one, the rest are dealt
    df = _groups_df(spark, 6000, 1500, 8, seed=5)
    _, shares = _check_folds(df, S.stratified_group_folds(df, 5, head_share=60), 5, 6000)
    assert all(abs(s - 0.2) <= 0.02 for s in shares)
    # no large group at all
    even = spark.range(4000).selectExpr("id as review_id", "id div 2 as book_id", "concat('u', id % 7) as user_id")
    _, shares = _check_folds(even, S.stratified_group_folds(even, 4, head_share=100), 4, 4000)
    assert all(abs(s - 0.25) <= 0.02 for s in shares)


def test_large_groups_are_not_collected(spark, monkeypatch):
    df = _groups_df(spark, 1200, 150, 15)
    collected, collect = [0], type(df).collect

    def counting(self):
        rows = collect(self)
        collected.append(len(rows))
        return rows

    monkeypatch.setattr(type(df), "collect", counting)
    folds = S.stratified_group_folds(df, 5)
    assert max(collected) < 100
    assert folds.count() == 150


@pytest.mark.parametrize("block", [1024, 16])
def test_greedy_folds_in_rounds_of_blocks(spark, block):
    """150 groups in blocks of 16: rounds of 1, 1, 2, 4 and 2 blocks, priced
    against the running table, stay close to one block that sees everything."""
    df = _groups_df(spark, 1200, 150, 15)
    folds = S.stratified_group_folds(df, 5, block_groups=block)
    j, shares = _check_folds(df, folds, 5, 1200)
    assert all(abs(s - 0.2) <= 0.02 for s in shares)
    dev = _deviation([(r.user_id, r.fold) for r in j.select("user_id", "fold").collect()], 5)
    rnd = random.Random(0)
    ids = [r.book_id for r in folds.select("book_id").collect()]
    rows = df.select("user_id", "book_id").collect()
    devs = []
    for _ in range(20):
        rf = {b: rnd.randrange(5) for b in ids}
        devs.append(_deviation([(r.user_id, rf[r.book_id]) for r in rows], 5))
    assert dev < 0.75 * min(devs)
    assert sorted(map(tuple, folds.collect())) == sorted(map(tuple, S.stratified_group_folds(df, 5, block_groups=block).collect()))


@pytest.mark.parametrize("column, most", [("user_id", 0.093), ("rating", 0.023)])
def test_greedy_folds_reach_the_surveyed_deviation(spark, column, most):
    from tomewise import fixtures
    df = fixtures.reviews(spark, "/root/testdata/sf0.01").where("book_id is not null and user_id is not null")
    df = df.select("book_id", F.col(column).cast("string").alias("user_id"))
    rows = df.join(S.stratified_group_folds(df, 5), "book_id").select("user_id", "fold").collect()
    from collections import Counter
    n = Counter(r.user_id for r in rows)
    assert _deviation([(r.user_id, r.fold) for r in rows if n[r.user_id] >= 5], 5) <= most
    assert all(abs(c / len(rows) - 0.2) <= 0.02 for c in Counter(r.fold for r in rows).values())


def test_one_group_and_a_hot_group(spark):
    one = spark.range(50).selectExpr("id as review_id", "7L as book_id", "concat('u', id % 3) as user_id")
    assert [r.book_id for r in S.stratified_group_folds(one, 5).collect()] == [7]
    hot = spark.range(3000).selectExpr("id as review_id", "if(id < 1000, 0, id div 10) as book_id", "concat('u', id) as user_id")
    for block in (1024, 32):
        folds = S.stratified_group_folds(hot, 4, head_share=50, block_groups=block)
        _, shares = _check_folds(hot, folds, 4, 3000)
        # the hot group fills one fold by itself, the others share the rest evenly
        assert sorted(round(x, 1) for x in shares) == [0.2, 0.2, 0.2, 0.3] and folds.count() == 201


def test_hot_users_and_books_can_be_split(spark):
    """Both sides of these joins are dealt for the join alone, so adaptive
    execution may split a partition that one user or book fills."""
    df = _groups_df(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (S.restrict_to_active(df), S.restrict_to_casual(df), S.stratified_deal_split(df),
                    S.stratified_greedy_split(df)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            join = plan[plan.index("SortMergeJoin"):]
            assert "__join_h" in join and join.count("Exchange hashpartitioning(__join_") >= 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_folds_with_null_groups_and_strata(spark):
    rows = [(i, i % 30, None if i % 30 < 6 else f"u{i % 4}") for i in range(300)] + [(900 + i, None, "u1") for i in range(20)]
    df = spark.createDataFrame(rows, "review_id long, book_id long, user_id string")
    for head in (2000, 20):
        folds = S.stratified_group_folds(df, 5, head_share=head)
        _check_folds(df, folds, 5, 300)
    for split in (S.group_split_exact(df), S.group_split_hash(df), S.stratified_deal_split(df), S.stratified_greedy_split(df)):
        assert {r.split for r in split.where("book_id is null").select("split").distinct().collect()} == {"train"}
        assert split.count() == 320 and split.where("split is null").count() == 0
    deal = S.deal_groups(df, 5)
    assert deal.where("fold is null").count() == 0 and deal.where("book_id is null").count() == 0
    assert S.stratified_group_folds(df.limit(0), 5).count() == 0


def test_casual_users_drop_rows_without_a_user(spark):
    rows = [(i, "a") for i in range(6)] + [(10, "b"), (11, None), (12, None)]
    df = spark.createDataFrame(rows, "review_id long, user_id string")
    assert [r.review_id for r in S.restrict_to_casual(df).collect()] == [10]
    assert S.restrict_to_active(df).count() == 6


def test_undersample_of_many_classes_keeps_the_same_rows(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, rnd.randrange(12)) for i in range(600)], "review_id long, rating int")
    a = sorted(r.review_id for r in SA.undersample(df).collect())
    b = sorted(r.review_id for r in SA.undersample(df, max_cut_classes=3).collect())
    assert a == b and a


def test_many_classes_meet_their_cuts_in_a_join(spark):
    rnd = random.Random(8)
    rows = [(i, None if rnd.random() < 0.02 else rnd.randrange(150) if rnd.random() < 0.7 else 0) for i in range(4000)]
    rows += [(i % 40, 151) for i in range(100)]  # ids in several rows: ties
    df = spark.createDataFrame(rows, "review_id long, rating int")
    by_class = {}
    for i, c in rows:
        if c is not None:
            by_class.setdefault(c, []).append((hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    for target in (None, 7, 0, 100_000):
        m = min(map(len, by_class.values())) if target is None else target
        out = SA.undersample(df, target=target)
        got = {}
        for r in out.collect():
            got.setdefault(r.rating, []).append(r.review_id)
        for c, ids in by_class.items():
            top = sorted(ids)[:m]
            # rows equal to the last one kept are told apart by nothing and stay together
            assert sorted(got.get(c, [])) == sorted(i for k, i in ids if top and (k, i) <= top[-1])
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("CASE WHEN") < 10


def test_greedy_split_no_leakage(spark):
    s = S.stratified_greedy_split(_groups_df(spark))
    assert _leak_free(s)


def test_active_restriction(spark):
    df = _groups_df(spark)
    act = S.restrict_to_active(df, min_reviews=60)
    cas = S.restrict_to_casual(df, min_reviews=60)
    assert act.count() + cas.count() == df.count()
    assert act.groupBy("user_id").count().where("count < 60").count() == 0


def test_positions_within_a_hot_key(spark):
    from tomewise.operators.ranking import positions_within
    rnd = random.Random(7)
    rows = [(i, "hot" if i % 3 else (f"k{rnd.randrange(20)}" if i % 2 else None), rnd.randrange(50)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, k string, v int")
    got = {r.id: r._pos for r in positions_within(df, "k", [F.col("v").desc(), F.col("id")]).collect()}
    for key in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == key), key=lambda r: (-r[2], r[0]))
        assert [got[r[0]] for r in own] == list(range(len(own)))


def test_order_statistics_are_exact(spark):
    import numpy as np
    from tomewise.operators import eda
    rng = np.random.default_rng(2)
    rows = [(g, float(x)) for g, n in (("a", 1), ("b", 2), ("c", 500), (None, 7)) for x in rng.integers(0, 90, n)]
    rows += [("c", None), ("c", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in eda.boxplot_stats(df, "g", "v").collect()}
    for g in ("a", "b", "c", None):
        x = np.array([v for k, v in rows if k == g and v is not None and v == v])
        q1, q2, q3 = np.percentile(x, [25, 50, 75])
        r = got[g]
        assert (r.n, r.q1, r.median, r.q3) == (len(x), q1, q2, q3)
        hi, lo = q3 + 1.5 * (q3 - q1), q1 - 1.5 * (q3 - q1)
        assert r.whisker_hi == max(x[x <= hi].max(), q3) and r.whisker_lo == min(x[x >= lo].min(), q1)
        assert r.n_outliers == ((x > hi) | (x < lo)).sum()
    d = eda.describe(df, "v").head()
    x = np.array([v for _, v in rows if v is not None and v == v])
    assert (d["count"], d["q25"], d["q50"], d["q75"]) == (len(x), *np.percentile(x, [25, 50, 75]))
    empty = eda.describe(df.where("g = 'none'"), "v").head()
    assert empty["count"] == 0 and empty["q50"] is None
    assert eda.boxplot_stats(df.where("g = 'none'"), "g", "v").count() == 0


def test_range_histogram_of_nothing(spark):
    from tomewise.operators import eda
    df = spark.createDataFrame([], "v double")
    assert [(r.n, r.lo) for r in eda.histogram_over_range(df, "v", 4).orderBy("bin").collect()] == [
        (0, 0.0), (0, 0.25), (0, 0.5), (0, 0.75)]


def test_global_positions_and_running_sum_match_brute_force(spark):
    from tomewise.operators.ranking import global_positions, global_running_sum
    rnd = random.Random(11)
    rows = [(i, rnd.randrange(40), rnd.randrange(1, 9)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, v int, w int").repartition(7)
    order = [F.col("v"), F.col("id")]
    want = sorted(rows, key=lambda r: (r[1], r[0]))
    pos = {r.id: r._pos for r in global_positions(df, order).collect()}
    assert pos == {r[0]: i for i, r in enumerate(want)}
    run, acc = {}, 0
    for r in want:
        acc += r[2]
        run[r[0]] = acc
    got = {r.id: r.cum for r in global_running_sum(df, order, "w", "cum").collect()}
    assert got == run


def test_bucket_digits_bounds():
    d = [SA.bucket_digits(n) for n in (1, 10**4, 10**6, 10**8, 10**10, 10**14)]
    assert d == sorted(d) and d[0] == 1 and max(d) == 5
    assert 10**8 / 16 ** SA.bucket_digits(10**8) <= 50_000


def test_active_user_split_equals_composition_with_nulls(spark):
    rnd = random.Random(21)
    rows = [(i, None if i % 17 == 0 else rnd.randrange(40), None if i % 23 == 0 else f"u{rnd.randrange(12)}")
            for i in range(500)]
    df = spark.createDataFrame(rows, "review_id long, book_id long, user_id string")
    got = sorted(tuple(r) for r in S.active_user_dealt_split(df).select("review_id", "split").collect())
    act = S.restrict_to_active(df)
    folds = S.deal_groups(act, 5, "book_id", "user_id", 42).select("book_id", "fold")
    want_df = (act.join(folds, "book_id", "left")
                  .withColumn("split", F.when(F.col("fold") == 0, "test").otherwise("train")))
    want = sorted(tuple(r) for r in want_df.select("review_id", "split").collect())
    assert got == want and len(got) > 0
