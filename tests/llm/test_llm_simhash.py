"""SimHash fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from tomewise.llm import graphs, simhash


def fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def check(rows, texts, bits=3):
    """texts: id -> text, ids ascending."""
    ids = sorted(texts)
    prints = [fingerprint(texts[i]) for i in ids]
    want = dict(zip(ids, [ids[g] for g in groups(prints, bits)]))
    assert sorted(r.doc_id for r in rows) == ids
    for r in rows:
        assert r.fingerprint == f"{prints[ids.index(r.doc_id)]:016x}"
        assert r.component_id == want[r.doc_id]


def near_copies(n, seed=0, words=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(0, 6)):
            own[rng.randrange(words)] = f"x{rng.randrange(9999)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("bits", [0, 1, 3, 5])
def test_components_match_brute_force(spark, bits):
    texts = dict(enumerate([None, "", "  \n", "One", "one", "ONE two", "É é", "a b c", "A  b\tC", "é b c", "É b c",
                            "x" * 100_000] + near_copies(60) + near_copies(60, 1, 30) + ["same text here again"] * 30))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    df = df.selectExpr("*", "'a' as fp", "'b' as fingerprint", "7 as component_id")
    out = simhash.near_duplicates(df, max_bits=bits)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    check(out.collect(), texts, bits)


def test_long_lists_are_keyed_again(spark):
    texts = dict(enumerate(near_copies(150, 3) + near_copies(20, 4)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(simhash.near_duplicates(df, max_bucket=2).collect(), texts)


def test_flipping_bits_finds_what_comparing_finds():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4).astype(np.uint64)
    x = np.unique(np.concatenate([b ^ (rng.integers(0, 2**24, 60).astype(np.uint64) & rng.integers(0, 2**24, 60).astype(
        np.uint64) & rng.integers(0, 2**24, 60).astype(np.uint64)) for b in base[:1]]))

    def classes(a, b):
        parent = {int(v): int(v) for v in x} | dict(zip(a.tolist(), b.tolist()))
        return {v: parent[v] for v in parent}

    assert classes(*simhash._forest(x, 3, 1)) == classes(*simhash._forest(x, 3, 4096))


def test_position_sets_meet_every_pair():
    from itertools import combinations
    for bits in range(8):
        sets = [set(s) for s in simhash.position_sets(bits)]
        for shared in combinations(range(8), 8 - bits):
            assert any(s <= set(shared) for s in sets)
    with pytest.raises(ValueError):
        simhash.position_sets(8)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (3, "other words in here"), (None, "lonely text of no id")]
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in out) == [(-1, -1), (-1, 5), (3, 3), (5, 5), (5, 5)]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(300, 300), (400, 401), (401, 400)]
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 200 for i in range(201, 260)}, 401: 400}


def test_real_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(simhash.near_duplicates(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
