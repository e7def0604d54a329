"""Hard negatives by a vertical scan with branch and bound.

Vectors are rows of integer components and a score is an inner product.  An
anchor's positives are its best rows of the same label; for each positive the
hard negatives are the best rows of other labels whose score lies in a window,
a range of percentages of the positive's score.  Both are window searches (the
positives' window is unbounded) and both go the same way: candidates are dealt
into blocks that are kept column by column, one column per dimension, with its
least and greatest value.  For an anchor the columns are read in the order of
falling magnitude of the anchor's components and add up to partial scores of
the candidates in its bitmap.  What the columns not yet read can still add lies
between the sums of their least and greatest contributions, which bounds every
candidate's score from both sides.  A candidate leaves the bitmap when no
window can hold it, or when a window surely holds as many candidates as are
wanted that are all surely better.  The least and greatest values are taken
again from the candidates left once most have gone.  When all columns are read
the bounds meet, so what is left resolves every window exactly.

Candidates and anchors are dealt by a hash of the whole row, never by label or
vector alone, so neither a label nor a vector that many rows share fills a
block; every block of anchors (a stated query set) meets every block of
candidates once per search, and each gives at most the wanted number of rows
per window, merged per anchor by a window function.

Sums are kept in doubles while they are exact, else in Python integers; a score
beyond a long counts as the nearest long.  Defined results: rows with a null
id, label, vector or component take no part; rows that are equal in id, label
and vector are one row; rows with the anchor's id are its own and neither
positive nor negative; anchors that share an id but differ in label or vector
are anchors of their own; components that a shorter vector lacks are zero;
ties go to the smaller id; a positive with a negative score has an empty
window; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomewise.llm.batches import quoted
from tomewise.session import reliable

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT = 30
HIGH_PERCENT = 90
# Rows of a block, and of the blocks of a small table, which gets several so
# that all cores work.
BLOCK = 65_536
SMALL_BLOCK = 4_096
SMALL_BLOCKS = 32
# Columns read between two looks at the bounds, and the share of candidates
# left at which the columns' least and greatest values are taken again.
STEP = 8
_AGAIN = 0.25
_LONG = np.iinfo(np.int64)


def _clip(scores: np.ndarray) -> np.ndarray:
    """Scores beyond a long as the nearest long; doubles are exact and within."""
    return np.minimum(np.maximum(scores, int(_LONG.min)), int(_LONG.max)) if scores.dtype == object else scores


class Block:
    """Candidates column by column; ``ids`` ascend."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(vectors.T)
        empty = not len(ids)
        self.least = np.zeros(len(self.columns), vectors.dtype) if empty else self.columns.min(axis=1)
        self.most = np.zeros(len(self.columns), vectors.dtype) if empty else self.columns.max(axis=1)

    def search(self, anchor: np.ndarray, bitmap: np.ndarray, windows: list[tuple]) -> tuple[list, int]:
        """Per window ``(low, high, k)`` the places and scores of the ``k``
        best of the candidates in ``bitmap`` with ``low <= score <= high``, and
        how many components were read."""
        kind = self.columns.dtype
        least_score, most_score = (np.array([w[i] for w in windows], kind)[:, None] for i in (0, 1))
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[:np.count_nonzero(anchor)]
        live = np.flatnonzero(bitmap)
        partial = np.zeros(len(live), kind)
        read = done = 0
        below, above = self._rest(anchor, order, self.least, self.most)
        taken = len(live)
        while done < len(order) and len(live):
            dims = order[done:done + STEP]
            partial = partial + anchor[dims] @ (self.columns[dims] if len(live) == len(self.ids)
                                                else self.columns[np.ix_(dims, live)])
            read += len(live) * len(dims)
            done += len(dims)
            if len(live) <= _AGAIN * taken and done < len(order):
                rest = self.columns[np.ix_(order[done:], live)]
                least, most = self.least.copy(), self.most.copy()
                least[order[done:]], most[order[done:]] = rest.min(axis=1), rest.max(axis=1)
                below, above = self._rest(anchor, order, least, most)
                taken = len(live)
            low, high = _clip(partial + below[done]), _clip(partial + above[done])
            may = (high >= least_score) & (low <= most_score)
            sure = (low >= least_score) & (high <= most_score)
            for w, n in enumerate(np.count_nonzero(sure, axis=1).tolist()):
                if n >= (k := windows[w][2]):
                    may[w] &= high >= np.partition(low[sure[w]], n - k)[n - k]
            stays = may.any(axis=0)
            if not stays.all():
                live, partial = live[stays], partial[stays]
        partial = _clip(partial)
        out = []
        for least, most, k in windows:
            at = np.flatnonzero((partial >= least) & (partial <= most))
            at = at[np.argsort(-partial[at], kind="stable")[:k]]
            out.append((live[at], partial[at]))
        return out, read

    @staticmethod
    def _rest(anchor, order, least, most) -> tuple[np.ndarray, np.ndarray]:
        """What the columns ``order[i:]`` add at least and at most, for every i."""
        a, b = anchor[order] * least[order], anchor[order] * most[order]
        total = lambda x: np.r_[np.cumsum(x[::-1])[::-1], np.zeros(1, x.dtype)]
        return total(np.minimum(a, b)), total(np.maximum(a, b))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as the rows of a matrix of longs, filled with zeros."""
    lists = column.combine_chunks()
    size = np.asarray(pa.compute.list_value_length(lists), np.int64)
    out = np.zeros((len(size), width), np.int64)
    if len(size):
        out[np.repeat(np.arange(len(size)), size),
            np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = np.asarray(lists.flatten(), np.int64)
    return out


def _peak(m: np.ndarray) -> int:
    return max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))


def _found(group: pa.Table, same_label: bool, k: int, names: list[str]) -> pa.Table:
    """The best rows of the group's candidates for each window of its anchors."""
    group = group.sort_by([("id", "ascending"), ("key", "ascending")])
    asks = group.column("asks").to_numpy(zero_copy_only=False)
    width = pa.compute.max(pa.compute.list_value_length(group.column("weights"))).as_py() or 0
    rows, anchors = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
    stored, asked = _matrix(rows.column("weights"), width), _matrix(anchors.column("weights"), width)
    kind = np.float64 if _peak(stored) * _peak(asked) * max(width, 1) < 2**53 else object
    ids = rows.column("id").to_numpy()
    keys = rows.column("key").to_numpy()
    label = {x: i for i, x in enumerate(pa.compute.unique(group.column("label")).to_pylist())}
    labels = np.array([label[x] for x in rows.column("label").to_pylist()], np.int64)
    block = Block(ids, labels, stored.astype(kind))
    out: list[list] = [[] for _ in names]
    for anchor_id, key, own, vector, windows in zip(
            anchors.column("id").to_pylist(), anchors.column("key").to_pylist(), anchors.column("label").to_pylist(),
            asked.astype(kind), anchors.column("windows").to_pylist()):
        bitmap = (block.labels == label[own]) == same_label
        bitmap[slice(*np.searchsorted(ids, [anchor_id, anchor_id + 1]))] = False
        bounds = [(-np.inf, np.inf, k)] if windows is None else [(w["low"], w["high"], k) for w in windows]
        for place, (at, scores) in enumerate(block.search(vector, bitmap, bounds)[0]):
            for values, more in zip(out, ([anchor_id] * len(at), [key] * len(at), [place] * len(at), ids[at].tolist(),
                                          keys[at].tolist(), [int(s) for s in scores])):
                values.extend(more)
    return pa.table([pa.array(x, pa.int64()) for x in out], names=names)


_HIT = ["anchor_id", "anchor_key", "place", "id", "key", "score"]


def _best(anchors: DataFrame, rows: DataFrame, same_label: bool, k: int, n_anchors: int, n_rows: int, block: int,
          small_block: int) -> DataFrame:
    """``_HIT`` and ``rank``: the ``k`` best rows per anchor and window."""
    n_c = max(math.ceil(n_rows / block), min(SMALL_BLOCKS, math.ceil(n_rows / min(small_block, block))), 1)
    n_q = max(math.ceil(n_anchors / block), 1)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n: int):
        return F.pmod(F.xxhash64("id", "key", F.lit(n)), F.lit(n)).cast("int")

    own = ["id", "key", "label", "weights"]
    # each side's rows go once to every block of the other side
    both = (anchors.select(F.lit(True).alias("asks"), *own, "windows", dealt(n_q).alias("q"), every(n_c).alias("c"))
            .unionByName(rows.select(F.lit(False).alias("asks"), *own,
                                     F.lit(None).cast(anchors.schema["windows"].dataType).alias("windows"),
                                     every(n_q).alias("q"), dealt(n_c).alias("c"))))
    hits = both.groupBy("q", "c").applyInArrow(lambda g: _found(g, same_label, k, _HIT),
                                               ", ".join(f"{c} long" for c in _HIT))
    order = Window.partitionBy("anchor_id", "anchor_key", "place").orderBy(F.col("score").desc(), "id", "key")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(anchors: DataFrame, rows: DataFrame, id_col: str = "id", label_col: str = "label",
                   weights_col: str = "weights", n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, block: int = BLOCK,
                   small_block: int = SMALL_BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank`` (from 1)``, negative_id,
    positive_score, negative_score``: for each anchor and each of its
    ``n_positives`` best rows of the same label the ``n_negatives`` best rows
    of other labels with ``low_percent * positive_score <= 100 * negative_score
    <= high_percent * positive_score``.  Weights are arrays of longs, ids are
    longs, labels of any type that casts to text."""
    def plain(df: DataFrame) -> DataFrame:
        columns = [F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(label_col)).cast("string").alias("label"),
                   F.col(quoted(weights_col)).cast("array<bigint>").alias("weights")]
        return (df.select(*columns).where("id is not null and label is not null and weights is not null "
                                          "and not exists(weights, x -> x is null)")
                  .distinct().withColumn("key", F.xxhash64("id", "label", "weights")))

    rows, anchors = plain(rows), reliable(plain(anchors))
    sizes = (anchors.count(), rows.count(), block, small_block)
    nothing = F.lit(None).cast("array<struct<low:bigint,high:bigint>>").alias("windows")
    positives = reliable(_best(anchors.select("*", nothing), rows, True, n_positives, *sizes).select(
        "anchor_id", "anchor_key", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")))
    # percentages of a long without leaving the longs; positives of no negative score come first
    share = "{0} * (positive_score div 100) + ({0} * (positive_score % 100) + {1}) div 100"
    asked = positives.where("positive_score >= 0").groupBy("anchor_id", "anchor_key").agg(
        F.sort_array(F.collect_list(F.struct(  # at most n_positives of them
            "place", F.expr(share.format(low_percent, 99)).alias("low"),
            F.expr(share.format(high_percent, 0)).alias("high")))).alias("w"))
    again = anchors.join(asked, (anchors["id"] == asked["anchor_id"]) & (anchors["key"] == asked["anchor_key"])).select(
        *anchors.columns, F.transform("w", lambda w: F.struct(w.low.alias("low"), w.high.alias("high"))).alias("windows"))
    found = _best(again, rows, False, n_negatives, *sizes).withColumn("place", F.col("place") + 1)
    return found.withColumnRenamed("id", "negative_id").join(positives, ["anchor_id", "anchor_key", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
