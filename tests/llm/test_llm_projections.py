"""Near-duplicate vectors by collision counting against all pairs."""

import numpy as np
import pytest

from scripts.check_oracle import compare, duck_con
from tomewise.llm import projections, queries

SCHEMA = "vec long, embedding array<double>, label string, N_LINKS string"


def plain(rows, least=0.93):
    """Row number -> (id, links, component), all pairs tried."""
    ok = {n: np.array(v, float) for n, (i, v, l) in enumerate(rows)
          if i is not None and l is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)}
    links = {n: set() for n in range(len(rows))}
    unit = {n: v / np.abs(v).max() for n, v in ok.items()}
    unit = {n: v / np.linalg.norm(v) for n, v in unit.items()}
    for n in ok:
        for m in ok:
            if n < m and rows[n][2] == rows[m][2] and len(ok[n]) == len(ok[m]) and unit[n] @ unit[m] >= least:
                links[n].add(m)
                links[m].add(n)
    out = []
    for n, (i, _, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        c = None if i is None else min(rows[m][0] for m in seen)
        out.append((i, len(links[n]), c, i == c))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "mine") for r in rows], SCHEMA).selectExpr("*", "1 as `digest.x`", "2 as copies")
    out = projections.near_duplicates(df.repartition(3), id_col="vec", **kw)
    assert out.columns == ["vec", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def near(rng, v, cosine):
    """A vector at ``cosine`` to ``v``."""
    u = v / np.linalg.norm(v)
    w = rng.normal(size=len(v))
    w -= (w @ u) * u
    return cosine * u + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def test_clusters_match_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=32).tolist(), rng.choice(list("ab"))) for i in range(200)]
    for i in range(200, 500):
        _, v, label = rows[rng.integers(60)]
        rows.append((i, (near(rng, np.array(v), rng.uniform(0.99, 1)) * rng.uniform(0.1, 9)).tolist(),
                     label if rng.random() < 0.9 else "a"))
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    some = near(rng, base, 0.99).tolist()
    rows = [(10, base.tolist(), "a"), (5, some, "a"), (4, some, "b"), (None, some, "a"), (6, None, "a"),
            (7, some, None), (8, [0.0] * 8, "a"), (9, [0.0] * 8, "a"), (11, [None, *some[1:]], "a"),
            (12, [float("nan"), *some[1:]], "a"), (13, [float("inf"), *some[1:]], "a"), (14, [], "a"), (15, [], "a"),
            (16, [2.0], "a"), (17, [3.0], "a"), (18, [-3.0], "a"), (19, some + [0.0], "a"),
            (20, (base * 1e300).tolist(), "a"), (21, (base * 1e-300).tolist(), "a"),
            (22, [0.0, 1.0], "c"), (23, [-0.0, 1.0], "c"), (24, [1.0, 0.0], "c"), (24, [0.0, 1.0], "c")]
    rows += [(5, some, "a"), (3, some, "a")] + [(i, base.tolist(), "a") for i in range(100, 140)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows[:0]) == []


@pytest.mark.parametrize("max_cell", [projections.MAX_CELL, 16])
def test_crowded_cells_lose_nothing(spark, max_cell):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, near(rng, base, rng.uniform(0.985, 1)).tolist(), "a") for i in range(150)]
    rows += [(i, rng.normal(size=16).tolist(), "a") for i in range(150, 220)] + [(i, rows[0][1], "a") for i in range(220, 260)]
    assert run(spark, rows, max_cell=max_cell) == plain(rows)


def test_recall_at_the_bound(spark):
    """Pairs as far apart as a link allows, among enough rows that a cell holds few of them."""
    rng = np.random.default_rng(4)
    rows, n = [], 3000
    for i in range(n):
        v = rng.normal(size=64)
        rows += [(2 * i, v.tolist(), "a"), (2 * i + 1, near(rng, v, rng.uniform(0.9301, 0.935)).tolist(), "a")]
    got = run(spark, rows)
    plan = projections.Plan(0.93, 2 * n)
    assert plan.slabs > projections.MIN_SLABS
    found = sum(r[1] for r in got) / 2 / n
    assert 0.98 <= found <= 1 and all(r[1] <= 1 for r in got)
    assert all(r[2] in (r[0], r[0] - 1) and (r[2] == r[0] - 1) <= (r[1] == 1) for r in got)


def test_calibration():
    rng = np.random.default_rng(5)
    for distance, slab in ((0.374, 2.0), (1.414, 2.0), (0.2, 0.5)):
        a, d = rng.random(200_000) * slab, rng.normal(0, distance, 200_000)
        assert abs(projections.same_slab(distance, slab) - (np.floor(a / slab) == np.floor((a + d) / slab)).mean()) < 0.005
    counts = rng.binomial(32, 0.8664, 200_000)
    need = projections.count_needed(32, 0.8664, 0.999)
    assert (counts >= need).mean() >= 0.9985 and (counts >= need + 1).mean() < 0.9995
    wide = [projections.Plan(0.93, n).tables for n in (100, 10_000, 1_000_000, 100_000_000)]
    assert wide == sorted(wide) and wide[-1] < 150


def test_cells_do_not_depend_on_the_batch():
    rng = np.random.default_rng(6)
    plan = projections.Plan(0.93, 100_000)
    unit = projections.unit_rows(rng.normal(size=(500, 64)))
    labels = np.arange(500)
    whole = plan.cells(unit, labels)
    for i in range(0, 500, 7):
        assert np.array_equal(plan.cells(unit[i:i + 3], labels[i:i + 3]), whole[i:i + 3])


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_matches_sql(spark, sf_dir):
    name = "op13_collision_projections"
    msg = compare(spark, duck_con(sf_dir), name, queries.QUERIES[name], queries.ORACLE[name], sf_dir)
    assert ": OK" in msg, msg
