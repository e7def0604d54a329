"""Hard negatives by vertical scan against brute force."""

import random

import numpy as np
import pytest

from scripts.check_oracle import compare, duck_con
from tomewise.llm import bond, queries

SCHEMA = "id long, label string, weights array<bigint>, SCORE string"


def plain(rows, anchors, n_pos=5, n_neg=10, low=30, high=90):
    def whole(rs):
        return sorted({(i, l, tuple(w)) for i, l, w in rs if i is not None and l is not None and w is not None
                       and None not in w})

    def dot(a, b):
        return max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))

    rows, out = whole(rows), []
    for i, l, w in whole(anchors):
        others = sorted((-dot(w, v), j, m) for j, m, v in rows if j != i)
        for s, j, _ in [x for x in others if x[2] == l][:n_pos]:
            fits = [x for x in others if x[2] != l and low * -s <= 100 * -x[0] <= high * -s]
            out += [(i, j, r, k, -s, -t) for r, (t, k, _) in enumerate(fits[:n_neg], 1)]
    return sorted(out)


def run(spark, rows, anchors, **kw):
    make = lambda rs: spark.createDataFrame([(*r, "mine") for r in rs], SCHEMA).selectExpr("*", "1 as `key.x`")
    out = bond.hard_negatives(make(anchors), make(rows).repartition(3), **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def some_rows(rng, n, width=6, top=9):
    return [(i, rng.choice("abc"), [rng.randint(-top // 3, top) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("block", [bond.BLOCK, 16])
def test_negatives_match_brute_force(spark, block):
    rows = some_rows(random.Random(block), 150)
    anchors = rows[::7]
    assert run(spark, rows, anchors, block=block, small_block=block) == plain(rows, anchors) != []


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = some_rows(rng, 40) + [(None, "a", [1] * 6), (90, None, [1] * 6), (91, "a", None), (92, "a", [1, None]),
                                 (93, "a", []), (94, "b", [3]), (95, "c", [1] * 9), (96, "a", [0] * 6)]
    rows += rows[:3]                                  # equal rows are one row
    rows += [(5, "b", [7] * 6), (5, "c", [2] * 6)]    # one id, several vectors and labels
    rows += [(200 + i, rng.choice("ab"), [4, 4, 4, 4, 4, 4]) for i in range(30)]  # one vector in many rows: ties
    anchors = rows[:12] + rows[40:50] + rows[51:57]
    assert run(spark, rows, anchors, small_block=16, block=32) == plain(rows, anchors)
    assert run(spark, rows, anchors, n_positives=2, n_negatives=3, low_percent=0, high_percent=100) == plain(
        rows, anchors, 2, 3, 0, 100)
    assert run(spark, rows[:0], anchors) == run(spark, rows, anchors[:0]) == []


def test_scores_beyond_doubles_and_longs(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), [rng.randint(0, 2**31), rng.randint(0, 2**31), 1]) for i in range(40)]
    assert run(spark, rows, rows[:8]) == plain(rows, rows[:8]) != []
    rows = [(i, rng.choice("ab"), [rng.randint(0, 2**62), rng.randint(0, 2**62)]) for i in range(30)]
    assert run(spark, rows, rows[:6]) == plain(rows, rows[:6])


def test_bounds_spare_columns():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * rng.normal(0, 0.125, (4000, 64)) * 0.9 ** np.arange(64))
    block = bond.Block(np.arange(4000), np.zeros(4000, np.int64), rows)
    for a in range(20):
        scores = rows @ rows[a]
        ((at, found),), read = block.search(rows[a], np.arange(4000) != a, [(-np.inf, np.inf, 5)])
        best = sorted((-s, i) for i, s in enumerate(scores) if i != a)[:5]
        assert list(zip((-found).tolist(), at.tolist())) == best
        assert read < 0.7 * 64 * 4000


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_matches_sql(spark, sf_dir):
    name = "op11_bond_negatives"
    msg = compare(spark, duck_con(sf_dir), name, queries.QUERIES[name], queries.ORACLE[name], sf_dir)
    assert ": OK" in msg, msg
