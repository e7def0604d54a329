"""Sources and sinks, versioned datasets, stage skipping, stream = batch."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.sources import datasets as IO


def test_csv_roundtrip_multiline_quotes_na(spark, scratch):
    rows = [(1, 'line one\nline "two"', 5), (2, "", 3), (3, "NA", 1), (4, None, 0), (5, "a,b\r\nc", 2)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    IO.write_csv(df, f"{scratch}/csv")
    back = IO.read_csv(spark, f"{scratch}/csv", T.StructType.fromJson(df.schema.jsonValue()))
    got = {r.review_id: r.review_text for r in back.collect()}
    assert got[1] == 'line one\nline "two"' and got[5] == "a,b\r\nc"
    assert got[2] is None and got[3] is None and got[4] is None


def test_csv_missing_value_strings(spark, scratch):
    rows = [(i, x) for i, x in enumerate([*IO.NA_STRINGS, "n", "NAN", "Null", "none", " NA"])]
    IO.write_csv(spark.createDataFrame(rows, "i int, t string"), f"{scratch}/csv")
    back = IO.read_csv(spark, f"{scratch}/csv", T.StructType.fromDDL("i int, t string"))
    assert {r.i: r.t for r in back.collect()} == {i: None if x in IO.NA_STRINGS else x for i, x in rows}
    kept = IO.read_csv(spark, f"{scratch}/csv", T.StructType.fromDDL("i int, t string"), na_values=False)
    assert kept.where("t = 'NaN'").count() == 1


def test_versions_manifest_and_latest(spark, scratch):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test"))
    v1 = IO.publish(spark, df.where("id < 5"), "ds", root=scratch)
    v2 = IO.publish(spark, df, "ds", root=scratch, partition_by="split")
    assert (v1, v2) == (1, 2)
    assert IO.read_latest(spark, "ds", root=scratch).count() == 10
    assert IO.latest_entry(spark, "ds", root=scratch)["rows"] == 10
    train = IO.read_split(spark, IO.latest_entry(spark, "ds", root=scratch)["path"], "train")
    assert train.count() == 7
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString() or \
        "split" in str(train._jdf.queryExecution().executedPlan().toString())


def test_two_writers_get_two_versions(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda i: IO.publish(spark, spark.range(i + 1), "shared", root=scratch), range(4)))
    assert sorted(versions) == [1, 2, 3, 4]
    assert IO.latest_entry(spark, "shared", root=scratch)["version"] == 4
    sizes = {spark.read.parquet(f"{scratch}/shared/version={v}").count() for v in versions}
    assert sizes == {1, 2, 3, 4}


def test_fingerprint_sees_nested_rewrites(spark, scratch):
    import os
    import time
    path = scratch.removeprefix("file:")
    os.makedirs(f"{path}/in/part")
    with open(f"{path}/in/part/a", "w") as f:
        f.write("one")
    before = IO.input_fingerprint(f"{path}/in")
    assert before == IO.input_fingerprint(f"{path}/in")
    time.sleep(1.1)
    with open(f"{path}/in/part/a", "w") as f:
        f.write("two")
    assert before != IO.input_fingerprint(f"{path}/in")
    assert IO.input_fingerprint(f"{path}/nothing").endswith("nothing")


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest

    from tomewise import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_materialize_skips_existing_stage(spark, scratch):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)
    a = IO.materialize(spark, "stage", "fp1", build, root=scratch)
    b = IO.materialize(spark, "stage", "fp1", build, root=scratch)
    c = IO.materialize(spark, "stage", "fp2", build, root=scratch)
    assert len(calls) == 2 and a.count() == b.count() == c.count() == 3


def test_metrics_log_and_reload(spark, scratch):
    IO.log_metrics(spark, "run1", {"valid_accuracy": 0.5, "f1_score_0": 0.25}, root=scratch)
    IO.log_metrics(spark, "run2", {"valid_accuracy": 0.6}, root=scratch)
    m = IO.read_metrics(spark, root=scratch)
    assert m.count() == 3
    empty = spark.range(0)
    assert IO.reload_if_empty(empty, lambda: spark.range(4)).count() == 4
    assert IO.reload_if_empty(spark.range(2), lambda: spark.range(4)).count() == 2


def test_stream_equals_batch(spark, scratch):
    from tomewise.operators import model as ML
    from tomewise.streaming import scorer as ST
    rows = [(i, f"Review {i} {'good great' if i % 2 else 'bad poor'}  text", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    models = {"lr": ML.train_classifier(df, ML.TrainConfig(num_features=256, max_iter=10)),
              "nb": ML.train_classifier(df, ML.TrainConfig(num_features=256, kind="naive_bayes"))}
    ST.land(df.where("review_id < 30"), f"{scratch}/in", n_files=2)
    ST.land(df.where("review_id >= 30"), f"{scratch}/in", n_files=3)
    q = ST.start_scorer(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/chk", models)
    q.awaitTermination()
    stream = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/out").collect())
    batch = sorted(tuple(r) for r in ST.batch_equivalent(df, models).collect())
    assert len(stream) == 120 and stream == batch


def test_bayes_stream_equals_batch_in_bounded_batches(spark, scratch):
    from tomewise.operators import bayes
    from tomewise.streaming import scorer as ST
    rows = [(i, f"Review {i} {'good great' if i % 2 else 'bad poor'}  text", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    vocab = spark.createDataFrame([(w,) for w in ("good", "great", "bad", "poor", "text")], "word string")
    models = {f"s{s}": bayes.fit(df, vocab, s) for s in (1.0, 0.1)}
    ST.land(df, f"{scratch}/in", n_files=5)
    q = ST.start_scorer(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/chk", models, max_files_per_trigger=2)
    q.awaitTermination()
    out = spark.read.parquet(f"{scratch}/out")
    assert out.select("batch").distinct().count() >= 2
    stream = sorted(tuple(r) for r in out.drop("batch").collect())
    assert stream == sorted(tuple(r) for r in ST.batch_equivalent(df, models).collect()) and len(stream) == 120
    assert all(r.label == r.review_id % 2 for r in out.collect())


def test_batch_killed_before_its_commit(spark, scratch, monkeypatch):
    """A reader in between sees no part of the batch; the rerun commits it once."""
    import pytest

    from tomewise.operators import bayes
    from tomewise.sources import commits
    from tomewise.streaming import scorer as ST
    rows = [(i, f"Review {i} {'good great' if i % 2 else 'bad poor'}  text", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    vocab = spark.createDataFrame([(w,) for w in ("good", "great", "bad", "poor", "text")], "word string")
    models = {"nb": bayes.fit(df, vocab)}
    ST.land(df, f"{scratch}/in", n_files=4)

    def start():
        return ST.start_scorer(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/chk", models, max_files_per_trigger=2)

    calls, commit = [], commits.commit

    def dies_at_the_second(spark_, staged, target):
        calls.append(target)
        if len(calls) == 2:
            assert 0 < spark_.read.parquet(staged).count() < 40  # written, not committed
            raise RuntimeError("killed")
        return commit(spark_, staged, target)

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", dies_at_the_second)
        m.setattr(commits, "remove", lambda *_: None)
        with pytest.raises(Exception, match="killed"):
            start().awaitTermination()
    seen = ST.read_scores(spark, f"{scratch}/out")
    assert 0 < seen.count() < 40 and {r.batch for r in seen.select("batch").distinct().collect()} == {0}
    start().awaitTermination()
    seen = ST.read_scores(spark, f"{scratch}/out")
    assert sorted(r.review_id for r in seen.collect()) == list(range(40))
    assert commits.remove_abandoned(spark, f"{scratch}/out", -1) == 1
    # a batch that runs again computes and writes nothing; another query's number is refused
    import json
    own = json.loads(commits.read_text(spark, f"{scratch}/chk/metadata"))["id"]
    again = ST.commit_batch(lambda: 1 / 0, spark, f"{scratch}/out", own, 1)
    assert again is False and ST.read_scores(spark, f"{scratch}/out").count() == 40
    with pytest.raises(ST.ForeignBatch):
        ST.commit_batch(lambda: 1 / 0, spark, f"{scratch}/out", "another", 1)


def test_score_models_single_pass_equals_each_model(spark):
    from tomewise.operators import model as ML
    from tomewise.operators.scoring import score_models
    rows = [(i, f"review {i} {'good great' if i % 3 else 'bad poor'} text", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    models = {"lr": ML.train_classifier(df, ML.TrainConfig(num_features=128, max_iter=5)),
              "nb": ML.train_classifier(df, ML.TrainConfig(num_features=128, kind="naive_bayes"))}
    got = sorted(tuple(r) for r in score_models(models, df).collect())
    want = sorted((r.review_id, name, r.prediction, r.confidence)
                  for name, m in models.items()
                  for r in ML.predict(m, df, ["review_id"]).collect())
    assert got == want and len(got) == 80
    plan = score_models(models, df)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_halving_sweep_keeps_the_trials_a_plain_version_keeps(spark):
    from tomewise.operators import model as ML
    words = ["good", "great", "bad", "poor", "odd", "text"]
    rows = [(i, " ".join(words[(i * k + k) % 6] for k in range(1, 6)), (i + i // 7) % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    train, valid = df.where("review_id % 3 != 0"), df.where("review_id % 3 = 0")
    res = ML.halving_sweep(spark, train, valid, n_trials=7, seed=3, parallelism=4, rungs=(1, 3)).collect()
    draws = {d["trial"]: d for d in ML.draw_trials(7, 3)}

    def accuracy(t, iterations):
        cfg = ML.TrainConfig(num_features=draws[t]["num_features"], reg_param=draws[t]["reg_param"], max_iter=iterations)
        return ML.accuracy_of(ML.predict(ML.train_classifier(train, cfg), valid, ["rating"]), "rating")

    got = {}
    for r in res:
        got.setdefault((r.bracket, r.rung), []).append((r.trial, r.iterations, r.valid_accuracy, r.survives))
    for b in range(ML.BRACKETS):
        alive = [t for t in range(7) if (t % 4 == 3) == (b == 1)]
        for rung in range(b, 3):
            its = {t: min((1, 3)[rung], draws[t]["max_iter"]) if rung < 2 else draws[t]["max_iter"] for t in alive}
            scored = sorted((-accuracy(t, its[t]), t) for t in alive)
            on = sorted(t for _, t in scored[:-(-len(scored) // ML.ETA)]) if rung < 2 else []
            assert sorted(got.pop((b, rung))) == sorted((t, its[t], -a, t in on) for a, t in scored)
            alive = on
    assert not got
    last = {r.trial: r for r in ML.last_rungs(spark.createDataFrame(res, ML.RUNG_SCHEMA)).collect()}
    assert sorted(last) == list(range(7)) and all(last[r.trial].valid_accuracy == r.valid_accuracy
                                                  for r in res if not r.survives)
    assert ML.survivors([(3, 0.5), (1, 0.5), (2, float("nan")), (0, 0.1)], 2) == [1, 3]
    assert ML.survivors([(5, float("nan"))]) == [5] and ML.survivors([]) == []


def test_sweep_one_width_at_a_time_results(spark):
    from tomewise.operators import model as ML
    rows = [(i, f"review {i} {'good great' if i % 2 else 'bad poor'} text", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    res = ML.sweep(spark, df.where("review_id % 3 != 0"), df.where("review_id % 3 = 0"),
                   n_trials=5, seed=3, parallelism=2).collect()
    assert [r.trial for r in res] == list(range(5))
    draws = ML.draw_trials(5, 3)
    assert [(r.max_iter, r.num_features) for r in res] == [(d["max_iter"], d["num_features"]) for d in draws]
    assert all(0.0 <= r.valid_accuracy <= 1.0 for r in res)
