"""ML4-ML6: a distributed text classifier, a seeded random sweep, the best trial.

Re-aim of fine-tuning a transformer: the same task (text to one of six
ratings, accuracy on held-out books) with a Spark ML pipeline
``Tokenizer -> HashingTF -> IDF -> LogisticRegression(multinomial)``.
Hashing needs no vocabulary pass; IDF is one aggregate; the optimiser
aggregates gradients over partitions.  The sweep fits one model per draw on
the fixed train/valid splits (re-splitting rows would leak books), all to the end
(``sweep``) or by successive halving (``halving_sweep``).
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TrainConfig:
    num_features: int = 1 << 14
    reg_param: float = 1e-3
    max_iter: int = 50
    text_col: str = "review_text"
    label_col: str = "rating"
    kind: str = "logistic"  # or "naive_bayes"


def featurizer_stages(cfg: TrainConfig):
    return [Tokenizer(inputCol=cfg.text_col, outputCol="_words"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=cfg.num_features),
            IDF(inputCol="_tf", outputCol="features")]


def classifier(cfg: TrainConfig):
    if cfg.kind == "naive_bayes":
        return NaiveBayes(featuresCol="features", labelCol=cfg.label_col, modelType="multinomial",
                          smoothing=1.0)
    return LogisticRegression(featuresCol="features", labelCol=cfg.label_col, family="multinomial",
                              regParam=cfg.reg_param, maxIter=cfg.max_iter)


def train_classifier(train: DataFrame, cfg: TrainConfig = TrainConfig()) -> PipelineModel:
    """ML4: fit the text pipeline on the train split.

    The featurised training set is cached once, in the input's partitions,
    and the classifier iterates over it; the result is one PipelineModel.
    """
    feat = Pipeline(stages=featurizer_stages(cfg)).fit(train)
    x = feat.transform(train).select("features", cfg.label_col).cache()
    try:
        clf = classifier(cfg).fit(x)
    finally:
        x.unpersist()
    return PipelineModel(stages=list(feat.stages) + [clf])


def fitted_model(spark: SparkSession, name: str, fingerprint: str, train_fn, root: str) -> PipelineModel:
    """A fitted model as a versioned artifact: saved once per fingerprint
    under ``root``, loaded afterwards."""
    import hashlib

    from tomewise.sources.commits import exists
    path = f"{root}/models/{name}/{hashlib.md5(fingerprint.encode()).hexdigest()[:16]}"
    if exists(spark, f"{path}/metadata"):
        return PipelineModel.load(path)
    model = train_fn()
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep..., prediction (int), confidence`` (probability of the predicted class)."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      F.array_max(vector_to_array("probability")).alias("confidence"))


def recomputed(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """``key, own_class, own_confidence, margin`` of the logistic model from its
    weights, in plain expressions: every class's score is its intercept plus
    the sum of weight times feature over the entries of a row's sparse features.
    ``margin`` is how far the best score is ahead."""
    *features, lr = model.stages
    weights, k = lr.coefficientMatrix.toArray(), lr.numClasses
    table = df.sparkSession.createDataFrame(
        [(i, *map(float, w)) for i, w in enumerate(weights.T)],
        "slot int, " + ", ".join(f"w{c} double" for c in range(k)))  # a row per hash slot, a parameter
    sparse = "features struct<type: int, size: int, indices: array<int>, values: array<double>>"
    x = F.from_json(F.to_json(F.struct("features")), sparse)["features"]
    rows = PipelineModel(stages=list(features)).transform(df).select(key, x.alias("x"))
    entries = rows.select(key, F.explode_outer(F.arrays_zip(F.col("x.indices").alias("slot"), F.col("x.values").alias("v"))).alias("e"))
    put = entries.select(key, "e.slot", "e.v").join(F.broadcast(table), "slot", "left")
    sums = put.groupBy(key).agg(*[F.coalesce(F.sum(F.col(f"w{c}") * F.col("v")), F.lit(0.0)).alias(f"s{c}") for c in range(k)])
    scores = F.array(*[F.col(f"s{c}") + F.lit(float(lr.interceptVector[c])) for c in range(k)])
    ranked = F.reverse(F.array_sort("s"))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("s")))
    return sums.select(key, scores.alias("s")).select(
        key, (F.array_position("s", F.array_max("s")) - 1).cast("int").alias("own_class"),
        (1 / total).alias("own_confidence"), (ranked[0] - ranked[1]).alias("margin"))


# ML5, ML6 ------------------------------------------------------------------

SWEEP_SPACE = {
    "reg_param": ("log_uniform", 1e-5, 1e-2),
    "max_iter": ("choice", [25, 50, 100]),
    "num_features": ("choice", [1 << 10, 1 << 12, 1 << 14]),
}

RESULT_SCHEMA = T.StructType([
    T.StructField("trial", T.IntegerType()),
    T.StructField("reg_param", T.DoubleType()),
    T.StructField("max_iter", T.IntegerType()),
    T.StructField("num_features", T.IntegerType()),
    T.StructField("valid_accuracy", T.DoubleType()),
])


def draw_trials(n_trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded random draws (log-uniform and choice), as a random sweep does."""
    space = space or SWEEP_SPACE
    rng = random.Random(seed)
    out = []
    for i in range(n_trials):
        d = {"trial": i}
        for k, spec in space.items():
            if spec[0] == "log_uniform":
                d[k] = 10 ** rng.uniform(math.log10(spec[1]), math.log10(spec[2]))
            else:
                d[k] = rng.choice(spec[1])
        out.append(d)
    return out


def accuracy_of(pred: DataFrame, label_col: str) -> float:
    r = pred.agg(F.avg((F.col("prediction") == F.col(label_col)).cast("double")).alias("a")).head()
    return float(r["a"]) if r["a"] is not None else float("nan")


def sweep(spark: SparkSession, train: DataFrame, valid: DataFrame, n_trials: int = 20, seed: int = 42,
          label_col: str = "rating", text_col: str = "review_text", parallelism: int = 8) -> DataFrame:
    """ML5: one fit per draw; the results table ``trial, params..., valid_accuracy``.

    The featurisation is fitted once per hash width and cached while that
    width's trials run (one width at a time); trials differ only in the
    classifier fit.  Up to ``parallelism`` trials are fitted at once
    (concurrent Spark jobs, as ``CrossValidator(parallelism=...)``); the
    results do not depend on the order.
    """
    from concurrent.futures import ThreadPoolExecutor

    trials = draw_trials(n_trials, seed)
    rows = []
    # One hash width at a time: its featurised train/valid sets are cached,
    # its trials fitted, and the cache released before the next width, so
    # at most one copy of the features is held.
    for nf in sorted({t["num_features"] for t in trials}):
        fcfg = TrainConfig(num_features=nf, text_col=text_col, label_col=label_col)
        fm = Pipeline(stages=featurizer_stages(fcfg)).fit(train)
        tr = fm.transform(train).select("features", label_col).cache()
        va = fm.transform(valid).select("features", label_col).cache()

        def run(t, tr=tr, va=va, nf=nf):
            cfg = TrainConfig(num_features=nf, reg_param=t["reg_param"], max_iter=t["max_iter"],
                              text_col=text_col, label_col=label_col)
            fitted = classifier(cfg).fit(tr)
            acc = accuracy_of(fitted.transform(va), label_col)
            return (t["trial"], float(t["reg_param"]), int(t["max_iter"]), int(nf), acc)

        try:
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                rows += list(pool.map(run, [t for t in trials if t["num_features"] == nf]))
        finally:
            tr.unpersist()
            va.unpersist()
    rows.sort(key=lambda r: r[0])
    return spark.createDataFrame(rows, RESULT_SCHEMA)


# Early termination: trials are fitted for a few iterations first, and only the
# best share of each rung is fitted for more.  The last rung is a trial's own
# number of iterations.
RUNG_ITERATIONS = (5, 15)
ETA = 3
BRACKETS = 2

RUNG_SCHEMA = T.StructType([
    T.StructField("bracket", T.IntegerType()), T.StructField("rung", T.IntegerType()),
    T.StructField("iterations", T.IntegerType()), *RESULT_SCHEMA.fields,
    T.StructField("survives", T.BooleanType()),
])


def survivors(scored: list[tuple[int, float]], eta: int = ETA) -> list[int]:
    """The trials of a rung that go on: the best ``1/eta``, rounded up, of
    ``(trial, accuracy)``; ties go to the smaller trial, no accuracy is last."""
    ranked = sorted(scored, key=lambda x: (-x[1] if x[1] == x[1] else math.inf, x[0]))
    return sorted(t for t, _ in ranked[:-(-len(ranked) // eta)])


def bracket_of(trial: int, n_brackets: int = BRACKETS, eta: int = ETA) -> int:
    """Trials in turn: of ``eta`` times as many as the next, a bracket gets its share."""
    sizes = [eta ** (n_brackets - 1 - b) for b in range(n_brackets)]
    at = trial % sum(sizes)
    return next(b for b in range(n_brackets) if at < sum(sizes[:b + 1]))


def halving_sweep(spark: SparkSession, train: DataFrame, valid: DataFrame, n_trials: int = 20, seed: int = 42,
                  label_col: str = "rating", text_col: str = "review_text", parallelism: int = 8,
                  n_brackets: int = BRACKETS, eta: int = ETA, rungs: tuple[int, ...] = RUNG_ITERATIONS) -> DataFrame:
    """ML5 with early termination: one row per (trial, rung) reached, ``bracket,
    rung, iterations, trial, params..., valid_accuracy, survives``.

    The draws are those of ``sweep``.  Trials are dealt to brackets, ``eta`` times
    as many to each as to the next; bracket b starts at rung b, so later, smaller
    brackets give every trial more iterations before the first cut.  In a rung every trial still in its
    bracket is fitted for the rung's iterations (its own number at most, and
    exactly that in the last rung) and scored on ``valid``; the best ``1/eta`` go on.
    All fits of a rung run as concurrent Spark jobs on features that are
    cached once per hash width, until no trial of that width is left.
    """
    from concurrent.futures import ThreadPoolExecutor

    trials = draw_trials(n_trials, seed)
    n_brackets = max(1, min(n_brackets, len(rungs) + 1))
    alive = {b: [t for t in trials if bracket_of(t["trial"], n_brackets, eta) == b] for b in range(n_brackets)}
    cached: dict[int, tuple[DataFrame, DataFrame]] = {}
    rows = []

    def features(width: int) -> tuple[DataFrame, DataFrame]:
        fm = Pipeline(stages=featurizer_stages(TrainConfig(num_features=width, text_col=text_col,
                                                           label_col=label_col))).fit(train)
        return tuple(fm.transform(d).select("features", label_col).cache() for d in (train, valid))

    def run(job) -> float:
        t, iterations = job
        tr, va = cached[t["num_features"]]
        cfg = TrainConfig(num_features=t["num_features"], reg_param=t["reg_param"], max_iter=iterations,
                          text_col=text_col, label_col=label_col)
        return accuracy_of(classifier(cfg).fit(tr).transform(va), label_col)

    try:
        for rung in range(len(rungs) + 1):
            jobs = [(b, t, min(rungs[rung], t["max_iter"]) if rung < len(rungs) else t["max_iter"])
                    for b, ts in alive.items() if rung >= b for t in ts]
            for width in sorted({t["num_features"] for _, t, _ in jobs} - cached.keys()):
                cached[width] = features(width)
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                scores = list(pool.map(run, [(t, i) for _, t, i in jobs]))
            for b in alive:
                own = [(t, i, a) for (of, t, i), a in zip(jobs, scores) if of == b]
                if own:
                    stays = survivors([(t["trial"], a) for t, _, a in own], eta) if rung < len(rungs) else []
                    alive[b] = [t for t, _, _ in own if t["trial"] in stays]
                    rows += [(b, rung, int(i), t["trial"], float(t["reg_param"]), int(t["max_iter"]),
                              int(t["num_features"]), a, t["trial"] in stays) for t, i, a in own]
            for width in cached.keys() - {t["num_features"] for ts in alive.values() for t in ts}:
                for d in cached.pop(width):
                    d.unpersist()
    finally:
        for pair in cached.values():
            for d in pair:
                d.unpersist()
    return spark.createDataFrame(sorted(rows), RUNG_SCHEMA)


def last_rungs(results: DataFrame) -> DataFrame:
    """The columns of ``sweep``'s results: each trial's last rung."""
    last = results.groupBy("trial").agg(F.max_by(F.struct(*RESULT_SCHEMA.names), "rung").alias("r"))
    return last.select("r.*")


def best_trial(results: DataFrame) -> DataFrame:
    """ML6: the trial with the highest validation accuracy (ties: first trial)."""
    best = F.max_by(F.struct(*[F.col(c) for c in results.columns]),
                    F.struct(F.col("valid_accuracy"), -F.col("trial")))
    return results.agg(best.alias("b")).select("b.*")
