"""The learned lexicon and the learned sub-word vocabulary against plain versions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tomewise.operators import lexicon as LX
from tomewise.operators import sentiment as SE
from tomewise.operators import subwords as SW
from tomewise.plans import prepare as P

SF001 = "/root/testdata/sf0.001"


# sub-words -------------------------------------------------------------------

def pieces(text):
    words = text.split(" ")
    return [words[0]] + [" " + w for w in words[1:]]


def join(symbols, pairs):
    out = []
    for s in symbols:
        if out and (out[-1], s) in pairs:
            out[-1] += s
        else:
            out.append(s)
    return out


def learn(texts, n_merges, top=SW.PAIRS_PER_ROUND, least=2):
    words = Counter(p for t in texts if t is not None for p in pieces(t))
    split = {p: [f"{b:02X}" for b in p.encode()] for p in words}
    merges, r = [], 0
    while len(merges) < n_merges:
        count = Counter()
        for p, n in words.items():
            for pair in zip(split[p], split[p][1:]):
                count[pair] += n
        ranked = sorted(((-n, a, b) for (a, b), n in count.items() if n >= least))[:top]
        chosen = []
        for n, a, b in ranked:
            if a != b and all(a != y and b != x for x, y, _ in chosen) or a == b and all(a not in c[:2] for c in chosen):
                chosen.append((a, b, -n))
        chosen = chosen[:n_merges - len(merges)]
        if not chosen:
            break
        merges += [(260 + len(merges) + k, r, *c) for k, c in enumerate(chosen)]
        split = {p: join(s, {(a, b) for a, b, _ in chosen}) for p, s in split.items()}
        r += 1
    return merges


def encoded(text, merges):
    ids = {f"{b:02X}": 4 + b for b in range(256)} | {a + b: i for i, _, a, b, _ in merges}
    out = []
    for p in pieces(text):
        s = [f"{b:02X}" for b in p.encode()]
        for r in sorted({m[1] for m in merges}):
            s = join(s, {(a, b) for _, of, a, b, _ in merges if of == r})
        out += [ids[x] for x in s]
    return out


TEXTS = ["aaaa aaa aa a", "", " ", "  two  spaces ", "the theme of the thesis", "né naïve 日本 日本語 \U0001F600", "the\nline\tend",
         None, "x", "banana bandana banana"]


@pytest.mark.parametrize("n_merges", [0, 7, 60])
def test_merges_and_ids_match_a_plain_learner(spark, n_merges):
    rng = random.Random(n_merges)
    texts = TEXTS + [" ".join("".join(rng.choice("abcé") for _ in range(rng.randint(0, 6))) for _ in range(8)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "review_id long, review_text string")
    merges = SW.learn_merges(df, n_merges=n_merges)
    want = learn(texts, n_merges)
    assert [tuple(r) for r in merges.orderBy("id").collect()] == want and len(want) == n_merges
    new = [(100 + i, t) for i, t in enumerate(["unseen words: zebra", "日", "aaaaaaa the banana", *TEXTS])]
    more = df.union(spark.createDataFrame(new, df.schema))
    out = SW.encode(more, merges)
    for r in out.collect():
        t = dict(enumerate(texts)).get(r.review_id, dict(new).get(r.review_id))
        assert r.input_ids == (None if t is None else encoded(t, want)), t
    back = {r.review_id: r.text for r in SW.decode(out, merges).collect()}
    assert back == dict(enumerate(texts)) | dict(new)


def test_merges_of_the_corpus_match_a_plain_learner(spark):
    train = P.train_rows(spark, SF001)
    texts = [r.review_text for r in train.select("review_text").collect()]
    merges = SW.learn_merges(train, n_merges=120)
    assert [tuple(r) for r in merges.orderBy("id").collect()] == learn(texts, 120)


def test_pairs_taken_together_do_not_overlap():
    assert SW.apart([("a", "b", 9), ("b", "c", 8), ("c", "d", 7), ("e", "e", 6), ("e", "f", 5), ("a", "d", 4),
                     ("d", "a", 3), ("a", "a", 2), ("x", "b", 1)]) == [
        ("a", "b", 9), ("c", "d", 7), ("e", "e", 6), ("a", "d", 4), ("x", "b", 1)]


# lexicon ---------------------------------------------------------------------

def test_lexicon_finds_the_words_that_ratings_turn_on(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        rating = rng.randrange(6)
        words = [rng.choice(["book", "story", "page", "read"]) for _ in range(12)]
        if rating >= 4:
            words += rng.choices(["superb", "fine", "book"], k=3)
        if rating <= 1:
            words += rng.choices(["awful", "dull", "book"], k=3)
        rows.append((i, " ".join(words), rating))
    rows += [(900, None, 5), (901, "", 0), (902, "superb awful", None)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    high, low = F.col("rating") >= 4, F.col("rating") <= 1
    lex = {r.word: r for r in LX.learn_lexicon(df, high, low).collect()}
    assert {"superb", "fine", "awful", "dull"} <= lex.keys() and "page" not in lex
    assert max(abs(r.polarity) for r in lex.values()) == 1 and lex["superb"].polarity > 0 > lex["awful"].polarity
    # by hand
    n, h, l = Counter(), Counter(), Counter()
    for _, t, rating in rows:
        for w in (t or "").split():
            n[w] += 1
            h[w] += rating is not None and rating >= 4
            l[w] += rating is not None and rating <= 1
    for r in LX.word_odds(df, high, low, "review_text").collect():
        a = 1000 * n[r.word] / n.total()
        odds = [math.log((c[r.word] + a) / (c.total() + 1000 - c[r.word] - a)) for c in (h, l)]
        z = (odds[0] - odds[1]) / math.sqrt(1 / (h[r.word] + a) + 1 / (l[r.word] + a))
        assert abs(r.z - z) < 1e-9 and (abs(z) >= LX.MIN_Z) == (r.word in lex)
    scored = {r.review_id: r.polarity for r in SE.polarity(
        df, LX.learn_lexicon(df, high, low), "review_text", ["review_id", "rating"]).collect()}
    mean = lambda rs: sum(scored[i] for i in rs) / len(rs)
    assert mean([i for i, _, r in rows if r is not None and r >= 4]) > 0 > mean([i for i, _, r in rows if r is not None and r <= 1])
    assert LX.learn_lexicon(df.limit(0), high, low).count() == 0


# top n-grams behind a sketch -----------------------------------------------------

@pytest.mark.parametrize("buckets", [1, 7, 1 << 16, None])
def test_top_behind_a_sketch_is_exact(spark, buckets):
    from tomewise.operators import ngrams as NG
    rng = random.Random(3)
    rows = [(rng.choice([0, 1, 1, 1, None]), f"w{int(rng.paretovariate(0.7))}") for _ in range(3000)]
    rows += [(2, "only"), (3, "tie b"), (3, "tie a"), (3, "tie c"), (2, None)]
    df = spark.createDataFrame(rows, "c int, item string")
    for k in (1, 2, 10, 5000):
        want = []
        for c in {r[0] for r in rows}:
            ranked = sorted(Counter(w for of, w in rows if of == c).items(), key=lambda x: (-x[1], x[0] is not None, x[0]))
            want += [(c, w, n, i) for i, (w, n) in enumerate(ranked[:k], 1)]
        got = [tuple(r) for r in NG.exact_top(df, "item", k, "c", buckets=buckets).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    got = [tuple(r) for r in NG.exact_top(df, "item", 3, buckets=buckets).collect()]
    ranked = sorted(Counter(w for _, w in rows).items(), key=lambda x: (-x[1], x[0] is not None, x[0]))
    assert sorted(got, key=lambda r: r[2]) == [(w, n, i) for i, (w, n) in enumerate(ranked[:3], 1)]
    assert NG.exact_top(df.limit(0), "item", 3, "c", buckets=buckets).count() == 0
