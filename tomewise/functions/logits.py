"""Column functions over logit arrays and service labels (ML8-ML10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(logits) -> Column:
    """0-based index of the first maximum (numpy's tie rule)."""
    l = _col(logits)
    return (F.array_position(l, F.array_max(l)) - 1).cast("int")


def _shifted_exp(l: Column) -> Column:
    m = F.array_max(l).cast("double")
    return F.transform(l, lambda x: F.exp(x.cast("double") - m))


def softmax(logits) -> Column:
    """Numerically stable softmax as an array of doubles."""
    e = _shifted_exp(_col(logits))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / total)


def confidence(logits) -> Column:
    """Probability of the predicted class: 1 / sum(exp(x - max))."""
    e = _shifted_exp(_col(logits))
    return F.lit(1.0) / F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)


def label_name(idx) -> Column:
    """Class index to the service label ``LABEL_<i>``."""
    return F.concat(F.lit("LABEL_"), _col(idx).cast("string"))


def label_to_rating(label) -> Column:
    """``LABEL_<i>`` to the integer i."""
    return F.substring_index(_col(label), "_", -1).cast("int")
