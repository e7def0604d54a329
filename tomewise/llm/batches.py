"""Helpers for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One Arrow batch is worked on in slices of about this many characters, so
# that the numpy arrays of a slice stay small whatever the batch holds.
SLICE_CHARS = 4_000_000


def texts_of(column: pa.Array) -> list[str]:
    """The column as Python strings; null becomes the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ``(start, end)`` ranges of at most ``limit`` characters,
    or of one text if that text alone is longer."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s:s+n]`` of every ``(s, n)``, concatenated."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = starts - (np.cumsum(lengths) - lengths)
    return values[np.repeat(shift, lengths) + np.arange(total)]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


def clashes(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` that an operator keeps beside its own ``names``."""
    own = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in own]


def schema_of(df: DataFrame, keep: list[str], added: list[T.StructField]) -> T.StructType:
    """The fields ``keep`` of ``df`` and then ``added``."""
    return T.StructType([df.schema[c] for c in keep] + added)


def numbered(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names`` as c0, c1, ...: a function over batches gets its
    columns by place, whatever characters their names have."""
    return df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)])


def quoted(name: str) -> str:
    """``name`` as a column reference, also with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"
