"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights; its terms are its positions, or a
column of their own.  Candidates and queries are dealt into blocks by a hash of
id and vector, equal rows only as often as they can be listed, and every query
block meets every candidate block in one group (a stated query set
against all rows, block by block).  In a group the candidates become posting
lists, one per term; a batch of queries goes through its terms one after the
other and adds weight times posting to a dense score per query and candidate.
The best k of the block are cut out by partition selection and the blocks'
results are merged per query.  Blocks hold a bounded number of rows, so memory
is bounded; small tables get smaller blocks, so that all cores work.

Sums are kept in doubles while they are exact, else in Python integers, and a
score beyond a long counts as the nearest long.  Defined results: rows with a
null id, a null vector or a null weight take no part; an empty vector scores
0; a candidate with the query's id is its own row and left out; repeated
candidate rows are each listed; repeated rows of a query count as one query,
with the highest of their scores; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.llm.batches import quoted

CANDIDATE_BLOCK = 65_536
SMALL_BLOCK = 1_024
SMALL_BLOCKS = 32
QUERY_BLOCK = 16_384
# Scores kept at once by a task, and the share of a block from which on a
# posting list is kept as a dense array.
_SCORES = 1_000_000
_DENSE = 0.25
_LONG = np.iinfo(np.int64)
# A candidate row is told apart by its id, the hash of its id and vector and,
# among equal rows, its number.
_FOUND = ["query_id", "id", "score", "key", "copy"]


class Postings:
    """Posting lists of a block of candidates, sorted by id."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int):
        order = np.argsort(terms, kind="stable")
        terms, rows, weights = terms[order], rows[order], weights[order]
        begin = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
        self.n, self.lists = n, {}
        for term, a, b in zip(terms[begin].tolist(), begin.tolist(), np.r_[begin[1:], len(terms)].tolist()):
            at, w = rows[a:b], weights[a:b]
            if b - a >= _DENSE * n:
                dense = np.zeros(n, w.dtype)
                np.add.at(dense, at, w)
                self.lists[term] = (None, dense)
            else:
                one, back = np.unique(at, return_inverse=True)  # a term repeated in a row counts in full
                total = np.zeros(len(one), w.dtype)
                np.add.at(total, back, w)
                self.lists[term] = (one, total)

    def scores(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        """Dense scores of ``n`` queries given as sparse entries."""
        out = np.zeros((n, self.n), weights.dtype)
        order = np.argsort(terms, kind="stable")
        terms, rows, weights = terms[order], rows[order], weights[order]
        begin = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
        for a, b in zip(begin.tolist(), np.r_[begin[1:], len(terms)].tolist()):
            if (posting := self.lists.get(int(terms[a]))) is None:
                continue
            at, w = posting
            weight = np.zeros(n, weights.dtype)
            np.add.at(weight, rows[a:b], weights[a:b])
            if at is None:
                out += weight[:, None] * w
            else:
                used = np.flatnonzero(weight)
                out[np.ix_(used, at)] += weight[used, None] * w
        return out


def select(scores: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of the ``k`` highest scores of each row, ties to the left."""
    n = scores.shape[1]
    if k >= n or scores.dtype == object:
        order = np.argsort(-scores, axis=1, kind="stable")
        return list(order[:, :k])
    bar = np.partition(scores, n - k, axis=1)[:, n - k]
    out = []
    for row, least in zip(scores, bar):
        above = np.flatnonzero(row > least)
        out.append(np.r_[above[np.argsort(-row[above], kind="stable")], np.flatnonzero(row == least)[:k - len(above)]])
    return out


def _sparse(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and the row, term and weight of every weight but zero."""
    weights, terms = table.column("weights").combine_chunks(), table.column("terms").combine_chunks()
    size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(weights), 0))
    w = np.asarray(weights.flatten(), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    if terms.null_count == len(terms):
        term = np.arange(len(w)) - np.repeat(np.cumsum(size) - size, size)
    else:
        term = np.asarray(terms.flatten(), np.int64)
    used = w != 0
    return table.column("id").to_numpy(), row[used], term[used], w[used]


def _search(group: pa.Table, k: int) -> pa.Table:
    asks = group.column("asks").to_numpy(zero_copy_only=False)
    stored = group.filter(pa.array(~asks)).sort_by([("id", "ascending"), ("key", "ascending"), ("copy", "ascending")])
    ids, row, term, weight = _sparse(stored)
    keys, copies = stored.column("key").to_numpy(), stored.column("copy").to_numpy()
    q_ids, q_row, q_term, q_weight = _sparse(group.filter(pa.array(asks)).sort_by("id"))
    out = ([], [], [], [], [])
    if len(ids) and len(q_ids):
        # an exact bound on every partial sum decides in what numbers to add
        terms = max(np.bincount(q_row).max(initial=0), 1)
        peak = lambda w: max(abs(int(w.max(initial=0))), abs(int(w.min(initial=0))))
        kind = np.float64 if peak(weight) * peak(q_weight) * int(terms) * int(np.bincount(row).max(initial=1)) < 2**53 else object
        postings = Postings(row, term, weight.astype(kind), len(ids))
        step = max(1, _SCORES // len(ids))
        own, first = np.unique(q_ids, return_index=True)
        last = np.r_[first[1:], len(q_ids)]
        a = 0
        while a < len(own):
            b = max(a + 1, int(np.searchsorted(last, first[a] + step, "right")))
            scores = None
            for begin in range(int(first[a]), int(last[b - 1]), step):  # several turns only for the rows of one id
                end = min(begin + step, int(last[b - 1]))
                lo, hi = np.searchsorted(q_row, [begin, end])
                part = postings.scores(q_row[lo:hi] - begin, q_term[lo:hi], q_weight[lo:hi].astype(kind), end - begin)
                part = np.maximum.reduceat(part, first[a:b] - first[a], axis=0)
                scores = part if scores is None else np.maximum(scores, part)
            if kind is object:
                scores = np.minimum(np.maximum(scores, int(_LONG.min)), int(_LONG.max))
            for query, line in zip(own[a:b].tolist(), scores):
                same = slice(*np.searchsorted(ids, [query, query + 1]))
                left = np.delete(np.arange(len(ids)), same) if same.stop > same.start else np.arange(len(ids))
                best = left[select(line[None, left], k)[0]]
                out[0].extend([query] * len(best))
                out[1].extend(ids[best].tolist())
                out[2].extend(int(s) for s in line[best])
                out[3].extend(keys[best].tolist())
                out[4].extend(copies[best].tolist())
            a = b
    return pa.table([pa.array(x, pa.int64()) for x in out], names=_FOUND)


def _dealt(queries: DataFrame, candidates: DataFrame, k: int, id_col: str, weights_col: str, terms_col: str | None,
           candidate_block: int, small_block: int, query_block: int) -> DataFrame:
    """The rows of both sides, once for each block ``q, c`` that they are in."""
    def rows(df: DataFrame) -> DataFrame:
        weights = F.col(quoted(weights_col))
        terms = F.col(quoted(terms_col)).cast("array<bigint>") if terms_col else F.lit(None).cast("array<bigint>")
        whole = F.col(quoted(id_col)).isNotNull() & weights.isNotNull() & ~F.exists(weights, lambda x: x.isNull())
        return df.where(whole).select(F.col(quoted(id_col)).cast("long").alias("id"), terms.alias("terms"),
                                      weights.cast("array<bigint>").alias("weights"))

    def blocks(n: int, largest: int, least: int = 1) -> int:
        return max(math.ceil(n / largest), min(SMALL_BLOCKS, math.ceil(n / least)) if least > 1 else 1, 1)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    n_c = blocks(candidates.count(), candidate_block, min(small_block, candidate_block))
    n_q = blocks(queries.count(), query_block)
    # each side's rows go once to every block of the other side
    vector = ["id", "terms", "weights"]
    key = F.xxhash64(*vector).alias("key")
    asked = rows(queries).distinct().select(
        F.lit(True).alias("asks"), *vector, key, F.lit(0).cast("long").alias("copy")).select(
        "*", F.pmod(F.xxhash64("key"), F.lit(n_q)).cast("long").alias("q"), every(n_c).alias("c"))
    stored = rows(candidates).groupBy(*vector).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(False).alias("asks"), *vector, key,
        F.explode(F.sequence(F.lit(0).cast("long"), F.least("n", F.lit(k).cast("long")) - 1)).alias("copy")).select(
        "*", every(n_q).alias("q"), F.pmod(F.xxhash64("key", F.lit(n_c)), F.lit(n_c)).cast("long").alias("c"))
    return asked.unionByName(stored)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, id_col: str = "id", weights_col: str = "weights",
          terms_col: str | None = None, candidate_block: int = CANDIDATE_BLOCK, small_block: int = SMALL_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank`` (from 1)``, id, score`` of each query's ``k`` best
    candidates by inner product, ties to the smaller id.  Weights are arrays of
    longs; ids are longs."""
    schema = T.StructType([T.StructField(c, T.LongType(), False) for c in _FOUND])
    rows = _dealt(queries, candidates, k, id_col, weights_col, terms_col, candidate_block, small_block, query_block)
    near = rows.groupBy("q", "c").applyInArrow(lambda group: _search(group, k), schema)
    # the rows of a query's id may be in several blocks and find a candidate each
    found = near.repartition("query_id").groupBy("query_id", "id", "key", "copy").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id", "key", "copy")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "id", "score"))


def quantised(column: str, scale: int = 256):
    """``floor(scale * x)`` of each component as longs; null if the vector or a
    component is null or not finite."""
    v = F.col(quoted(column))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(v.isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))
