"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tomewise.llm import periodic, queries

SF001 = "/root/testdata/sf0.001"


def runs(w, min_length=24, min_periods=3):
    """Every period tried on every place."""
    n, out = len(w), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(min_length, min_periods * q) and not any(
                    w[s + r:s + length] == w[s:s + length - r] for r in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, found):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found)]


def some_words(rng):
    k = rng.choice([1, 2, 2, 3])
    w = [rng.randrange(k) for _ in range(rng.randrange(90))]
    if rng.random() < 0.7:
        block = [rng.randrange(3) for _ in range(rng.randrange(1, 12))]
        w += (block * 30)[:rng.randrange(10, 80)] + [rng.randrange(k) for _ in range(rng.randrange(30))]
    return w


@pytest.mark.parametrize("limits", [(24, 3), (4, 2), (6, 3), (2, 2), (10, 4)])
def test_runs_match_brute_force(limits):
    rng = random.Random(limits[0])
    for _ in range(300):
        w = some_words(rng)
        assert [tuple(r) for r in periodic.runs_of(np.array(w, np.int64), *limits).tolist()] == runs(w, *limits)


def test_places_in_chunks(monkeypatch):
    monkeypatch.setattr(periodic, "_CHUNK", 4)
    rng = random.Random(0)
    for _ in range(200):
        xs = rng.sample(range(300), rng.randrange(2, 60))
        cut = rng.randrange(1, len(xs))
        big, small = periodic.Places(xs[0]), periodic.Places(xs[cut])
        for x in xs[1:cut]:
            big.add(x)
        for x in xs[cut + 1:]:
            small.add(x)
        pairs = lambda s: set(zip(sorted(s), sorted(s)[1:]))
        want = pairs(xs) - pairs(xs[:cut]) - pairs(xs[cut:])
        assert set(periodic.new_neighbours(big, small)) == want and list(big) == sorted(xs) and big.size == len(xs)


def test_long_texts_stay_quick():
    for w in ([0] * 100_000, [0, 1] * 50_000, list(range(50)) * 2_000):
        (one,) = periodic.runs_of(np.array(w, np.int64)).tolist()
        assert one == [0, len(w), len(set(w))]


def test_operator_on_odd_rows(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "a " * 24, "a " * 23, "x y " * 30, "é\x0bb " * 12, "q " + "a b c " * 9 + "a z",
             "one two " * 40_000, "a " * 24] + [" ".join(f"w{x}" for x in some_words(rng)) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "id long, text string, RUNS string") \
        .selectExpr("*", "1 as `x.y`", "id as n_words").repartition(3)
    out = periodic.periodic_runs(df)
    assert out.columns == ["id", "text", "x.y", "n_words", "runs", "strongest", "collapsed_text"]
    rows = out.collect()
    assert sorted(r.id for r in rows) == list(range(len(texts)))
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r.id] or "")
        want = runs(w) if len(w) < 1000 else [(0, len(w), 2)]
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(w) and r.text == texts[r.id]
        if len(w) < 1000:
            assert r.collapsed_text == " ".join(collapse(w, want))
        best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.strongest and tuple(r.strongest)) == best
    assert [r for r in rows if r.id == 8][0].collapsed_text == "one two"
    empty = periodic.periodic_runs(df.limit(0))
    assert empty.count() == 0 and empty.columns == out.columns


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF001).collect()}
    assert got.keys() == docs.keys()
    looped = 0
    for i, text in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j if j < a else a + (j - a) % p] for j in range(n)]
            looped += 1
        if n > 3000:  # the brute force's time grows with the square
            continue
        want = runs(w)
        best = min(want, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        r, sha = got[i], lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (best[1] * 1000 // best[2] if want else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in want))
        assert r.collapsed_sha256 == sha(" ".join(collapse(w, want)))
    assert looped > 5 and sum(r.n_runs > 0 for r in got.values()) > 5


def test_loops_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (6, None), (7, ""), (8, "  ")] + [(i, "a  b\tc\nd e") for i in range(90)],
                               "doc_id long, text string")
    for r in queries.with_loops(df).collect():
        if r.doc_id is None:
            assert r.text == "a b c"
        elif r.text and "e" in (r.text or ""):
            continue
        else:
            assert r.doc_id in (6, 7, 8) or zlib.crc32(str(r.doc_id).encode()) % 10 == 0
