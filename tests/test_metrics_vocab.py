"""Scoring functions, evaluation metrics and the vocabulary codec."""

import math
import random

from pyspark.sql import functions as F

from tomewise.functions import logits as LG
from tomewise.operators import metrics as M
from tomewise.operators import vocab as V


def _logit_rows(n=300, k=6, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        l = [round(rnd.uniform(-3, 3), 1) for _ in range(k)]
        rows.append((i, ["train", "valid", "test"][i % 3], rnd.randrange(k), l))
    return rows


def test_argmax_softmax_confidence(spark):
    rows = _logit_rows() + [(999, "test", 0, [1.0, 3.0, 3.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, split string, label int, logits array<float>")
    out = df.select("id", "logits", LG.argmax("logits").alias("p"), LG.softmax("logits").alias("sm"),
                    LG.confidence("logits").alias("c")).collect()
    for r in out:
        l = [float(x) for x in r.logits]
        assert r.p == l.index(max(l))  # first maximum wins
        assert abs(sum(r.sm) - 1.0) < 1e-9
        assert abs(r.c - max(r.sm)) < 1e-12


def test_label_names_round_trip(spark):
    df = spark.range(6).select(F.col("id").cast("int").alias("i"))
    r = df.select(LG.label_to_rating(LG.label_name("i")).alias("j"), "i").collect()
    assert all(x.i == x.j for x in r)


def _scored(spark):
    rows = _logit_rows()
    df = spark.createDataFrame(rows, "review_id long, split string, label int, logits array<float>")
    return df.withColumn("prediction", LG.argmax("logits")), rows


def test_confusion_and_f1_against_brute_force(spark):
    scored, rows = _scored(spark)
    pred = {r.review_id: r.prediction for r in scored.collect()}
    cm = M.confusion_matrix(scored)
    assert cm.agg(F.sum("n")).head()[0] == len(rows)
    for split in ("train", "valid", "test"):
        sub = [(lab, pred[i]) for i, s, lab, _ in rows if s == split]
        seen = {a for a, _ in sub} | {b for _, b in sub}
        got = {(r.label, r.prediction): r.n for r in cm.where(F.col("split") == split).collect()}
        assert len(got) == len(seen) ** 2
        for a in seen:
            for b in seen:
                assert got[(a, b)] == sum(1 for x in sub if x == (a, b))
    test = scored.where("split = 'test'")
    f1 = {r.label: r.f1 for r in M.f1_per_class(test, list(range(8))).collect()}
    sub = [(lab, pred[i]) for i, s, lab, _ in rows if s == "test"]
    for c in range(8):
        tp = sum(1 for a, b in sub if a == b == c)
        den = sum(1 for a, _ in sub if a == c) + sum(1 for _, b in sub if b == c)
        assert abs(f1[c] - (2 * tp / den if den else 0.0)) < 1e-12
    acc = {r.split: r.accuracy for r in M.accuracy(scored).collect()}
    micro = {r.split: r for r in M.micro_metrics(scored).collect()}
    for s in acc:
        assert abs(micro[s].f1_micro - acc[s]) < 1e-12
        assert abs(micro[s].precision_micro - acc[s]) < 1e-12


def test_vocab_encode_decode(spark):
    texts = ["the cat sat on the mat", "the dog", "", "zebra " * 600]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "review_id long, review_text string")
    vocab = V.build_vocab(df, size=3)
    words = {r.word: r.id for r in vocab.collect()}
    assert words == {"zebra": 4, "the": 5, "cat": 6}
    enc = V.encode(df, vocab, max_length=16)
    rows = {r.review_id: r for r in enc.collect()}
    assert all(len(r.input_ids) == 16 and len(r.attention_mask) == 16 for r in rows.values())
    assert rows[0].input_ids[:8] == [2, 5, 6, 1, 1, 5, 1, 3] and sum(rows[0].attention_mask) == 8
    assert rows[2].input_ids[:3] == [2, 3, 0]
    assert rows[3].input_ids == [2] + [4] * 14 + [3]  # truncated to max_length
    dec = {r.review_id: r.text for r in V.decode(enc, vocab).collect()}
    assert dec[0] == "the cat the" and dec[2] == "" and dec[3] == " ".join(["zebra"] * 14)


def test_metric_registry_and_log(spark, scratch):
    from tomewise.sources import datasets as IO
    scored, _ = _scored(spark)
    M.register_metric("n_rows", lambda d: d.groupBy("split").count())
    res = M.compute_metrics(scored, ["accuracy", "n_rows"])
    IO.log_metric_table(res["accuracy"], "r1", ["split"], scratch)
    flat = {r.key: r.value for r in IO.read_metrics(spark, scratch).where("run_id = 'r1'").collect()}
    assert set(flat) == {f"{s}_{c}" for s in ("train", "valid", "test") for c in ("n", "accuracy")}
    assert sum(r["count"] for r in res["n_rows"].collect()) == 300


def test_external_model_is_loaded_once_per_worker(spark, tmp_path):
    from tomewise.operators.scoring import score_external
    loads = str(tmp_path / "loads")

    def _load_tiny():
        import os
        import uuid
        os.makedirs(loads, exist_ok=True)
        open(f"{loads}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        class TinyModel:
            """Logits = counts of a few letters (stands in for a model file)."""
            def predict_logits(self, texts):
                return [[t.count(c) for c in "abc"] for t in texts]
        return TinyModel()

    rows = [("k1", "aaab"), ("k2", "bbc"), ("k3", "ccca"), ("k4", None)]
    df = spark.createDataFrame(rows, "key string, t string")
    out = {r.key: r for r in score_external(df, _load_tiny, "tiny-test", "t", "key", 3).collect()}
    assert [out[f"k{i}"].prediction for i in (1, 2, 3, 4)] == [0, 1, 2, 0]
    assert abs(out["k4"].confidence - 1 / 3) < 1e-12
    for _ in range(3):
        score_external(df.repartition(6), _load_tiny, "tiny-test", "t", "key", 3).count()
    import os
    pids = [f.split("-")[0] for f in os.listdir(loads)]
    assert len(pids) == len(set(pids))  # one load in each worker, however many tasks it ran


def test_naive_bayes_matches_the_formula(spark):
    from tomewise.operators import bayes
    rows = [(1, "a a b", 0), (2, "b c", 1), (3, "a", 0), (4, "c c d", 2), (5, "", 1), (6, None, 2), (7, "x", None)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    words = ["a", "b", "c"]
    model = bayes.fit(df, spark.createDataFrame([(w,) for w in words], "word string"), smoothing=0.5)
    assert model.classes == [0, 1, 2]
    texts = {c: [w for _, t, k in rows if k == c for w in (t or "").split() if w in words] for c in (0, 1, 2)}
    prior = {c: math.log(sum(k == c for *_, k in rows) / 6) for c in (0, 1, 2)}

    def scores(text):
        return [prior[c] + sum(math.log((texts[c].count(w) + 0.5) / (len(texts[c]) + 1.5))
                               for w in (text or "").split() if w in words) for c in (0, 1, 2)]
    got = {r.review_id: r for r in model.score(df, ["review_id"]).collect()}
    assert len(got) == 7
    for i, t, _ in rows:
        s = scores(t)
        assert got[i].prediction == s.index(max(s))
        assert abs(got[i].confidence - 1 / sum(math.exp(x - max(s)) for x in s)) < 1e-12


def test_row_key_is_content_based(spark):
    from tomewise.fixtures import with_row_key
    a = spark.createDataFrame([("x", 1), ("y", 2)], "t string, r int")
    k1 = {r.t: r.review_id for r in with_row_key(a, ["t", "r"]).collect()}
    k2 = {r.t: r.review_id for r in with_row_key(a.repartition(3), ["t", "r"]).collect()}
    assert k1 == k2 and len(set(k1.values())) == 2
    same = spark.createDataFrame([("x", 1)] * 50 + [("y", 2), (None, None), (None, None)], "t string, r int")
    keys = [r.review_id for r in with_row_key(same.repartition(4), ["t", "r"]).collect()]
    again = [r.review_id for r in with_row_key(same.repartition(2), ["t", "r"]).collect()]
    assert len(set(keys)) == 53 and set(keys) == set(again)


def test_undersample_approx_is_near_balanced(spark):
    from tomewise.operators.sampling import undersample_approx
    df = spark.range(6000).select(F.col("id").alias("review_id"),
                                  F.when(F.col("id") < 1000, 0).otherwise(1).alias("rating"))
    c = {r.rating: r["count"] for r in undersample_approx(df, "rating", 42).groupBy("rating").count().collect()}
    assert c[0] == 1000 and 850 < c[1] < 1150


def test_spearman_average_ranks(spark):
    import random as _r
    from tomewise.operators import eda
    rnd = _r.Random(4)
    rows = [(rnd.randrange(6), rnd.random() * 100 if i % 7 else None, float(rnd.randrange(30))) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b double, c double")

    def py_rank(xs):
        order = sorted(range(len(xs)), key=lambda i: xs[i])
        r = [0.0] * len(xs)
        i = 0
        while i < len(xs):
            j = i
            while j + 1 < len(xs) and xs[order[j + 1]] == xs[order[i]]:
                j += 1
            for k in range(i, j + 1):
                r[order[k]] = (i + j) / 2 + 1
            i = j + 1
        return r

    def py_spearman(x, y):
        keep = [(u, v) for u, v in zip(x, y) if u is not None and v is not None]
        rx, ry = py_rank([u for u, _ in keep]), py_rank([v for _, v in keep])
        mx, my = sum(rx) / len(rx), sum(ry) / len(ry)
        cov = sum((p - mx) * (q - my) for p, q in zip(rx, ry))
        return cov / math.sqrt(sum((p - mx) ** 2 for p in rx) * sum((q - my) ** 2 for q in ry))

    cols = list(zip(*rows))
    exp = py_spearman(cols[0], cols[1])
    assert abs(eda.spearman(df, "a", "b") - exp) < 1e-9
    assert abs(eda.spearman(df, "a", "c") - py_spearman(cols[0], cols[2])) < 1e-9
    assert abs(eda.spearman(df, "b", "c") - py_spearman(cols[1], cols[2])) < 1e-9


def test_spearman_of_constant_and_empty_columns(spark):
    from tomewise.operators import eda
    df = spark.createDataFrame([(i, 1, None) for i in range(9)], "a int, b int, c double")
    got = {(r.var_a, r.var_b): r.rho for r in eda.spearman_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "a")] == 1.0 and all(math.isnan(got[k]) for k in [("b", "b"), ("a", "b"), ("b", "a"), ("c", "c")])
    assert got[("a", "c")] is None or math.isnan(got[("a", "c")])
    assert math.isnan(eda.spearman(df, "a", "b"))


def test_spearman_matrix_shared_ranks_equal_pairwise(spark):
    import random as _r
    from tomewise.operators import eda
    rnd = _r.Random(9)
    rows = [(rnd.randrange(6), float(rnd.randrange(40)), rnd.random() if i % 9 else float("nan"),
             float(rnd.randrange(8)) if i % 11 else None, rnd.randrange(100)) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d double, e long")
    cols = ["a", "b", "c", "d", "e"]
    got = {(r.var_a, r.var_b): r.rho for r in eda.spearman_matrix(df, cols).collect()}
    assert len(got) == 25
    for x in cols:
        for y in cols:
            want = 1.0 if x == y else eda.spearman(df, x, y)
            assert abs(got[(x, y)] - want) < 1e-12, (x, y)
