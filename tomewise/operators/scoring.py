"""ML7, ML11: batch scoring of every split with one or several models.

Fitted Spark ML models score with ``transform`` inside the executors.  An
external model (a file loaded by Python) goes through ``score_external``:
``mapInPandas`` with Arrow batches and one model load per Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.operators.model import predict


def score_splits(model: PipelineModel, df: DataFrame, key: str = "review_id",
                 label_col: str = "rating") -> DataFrame:
    """``key, split, label, prediction, confidence`` for every row."""
    p = predict(model, df, [key, "split", label_col])
    return p.withColumnRenamed(label_col, "label")


def score_models(models: dict[str, PipelineModel], df: DataFrame, key: str = "review_id") -> DataFrame:
    """Long result ``key, model_name, label, score`` of several models.

    The models are applied one after another to the same rows (each one's
    prediction and confidence kept under a private name before the next
    model adds its own columns), then the results are exploded to the long
    form: the input is read once, not once per model, which for a stream
    means each micro-batch's files are scanned once.
    """
    base = df.columns
    cur, kept, entries = df, [], []
    for i, (name, m) in enumerate(models.items()):
        p, c = f"_pred{i}", f"_conf{i}"
        out = m.transform(cur)
        cur = out.select(*base, *kept, F.col("prediction").cast("int").alias(p),
                         F.array_max(vector_to_array("probability")).alias(c))
        kept += [p, c]
        entries.append(F.struct(F.lit(name).alias("model_name"), F.col(p).alias("label"),
                                F.col(c).alias("score")))
    longf = cur.select(key, F.explode(F.array(*entries)).alias("_m"))
    return longf.select(key, "_m.model_name", "_m.label", "_m.score")


def score_external(df: DataFrame, load: Callable[[], object], name: str, text_col: str, key: str,
                   n_classes: int) -> DataFrame:
    """Score with a Python model ``m.predict_logits(list[str]) -> ndarray``.

    ``load`` runs once per Python worker; ``name`` tells models apart, so two
    loaders need two names.  The model gets Arrow batches
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows) and must give
    ``n_classes`` logits per text; a null text is the empty one.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        from tomewise.operators.external import loaded
        m = loaded(name, load)
        for b in batches:
            logits = np.asarray(m.predict_logits(b[text_col].fillna("").tolist()), dtype="float64")
            if logits.shape != (len(b), n_classes):
                raise ValueError(f"{name} gave logits of shape {logits.shape} for {len(b)} texts")
            z = np.exp(logits - logits.max(axis=1, keepdims=True))
            pr = z / z.sum(axis=1, keepdims=True)
            yield pd.DataFrame({key: b[key], "prediction": logits.argmax(axis=1).astype("int32"),
                                "confidence": pr.max(axis=1)})

    schema = T.StructType([df.schema[key], T.StructField("prediction", T.IntegerType()),
                           T.StructField("confidence", T.DoubleType())])
    return df.select(key, text_col).mapInPandas(run, schema)
