"""Periodic runs of words by Kruskal's rule on a suffix array.

A run is a stretch of words with smallest period p (words p apart are equal)
that no neighbouring word extends.  The suffixes of a text are sorted by prefix
doubling, and neighbours are united in order of falling common prefix by
union-find, each class keeping its places in order.  When two classes meet at a
common prefix of l words, two places i < j that become neighbours in the united
class have exactly l words in common, so if j - i <= l the words from i to
j + l have period p = j - i.  Every run appears in this way: its start s and
s + p share length - p words, at least one period, and a place of the same
class between them would make the period's word, which is primitive, equal to
one of its own rotations.  For the same reason p is the smallest period.  A
pair that a word on its left would extend belongs to a run that starts earlier
and is left to that run's own pair.

A run of ``min_length`` words and ``min_periods`` periods needs a common prefix
of ``min_length * (min_periods - 1) / min_periods`` words, so suffixes whose
beginning of that length occurs once in their text take no part; ordinary prose
is done after a few rounds of sorting.  Texts are independent rows: nothing is
shuffled.

Words are runs of characters other than space and \\x09-\\x0D.  Defined
results: a null or empty text has no words and no runs; repeated rows give
repeated results; added columns replace columns of the same name, others are
kept.
"""

from __future__ import annotations

from bisect import bisect_right
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tomewise.llm.batches import clashes, numbered, quoted, schema_of, slices, texts_of
from tomewise.llm.repetition import _Number, _ranks

MIN_LENGTH = 24
MIN_PERIODS = 3
_CHUNK = 1_024
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


class Places:
    """Places in ascending order, in chunks, so that one more among very many
    moves a chunk only."""

    __slots__ = ("chunks", "first", "size")

    def __init__(self, place: int):
        self.chunks, self.first, self.size = [[place]], [place], 1

    def __iter__(self):
        return (x for chunk in self.chunks for x in chunk)

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The places next to ``x``, which is not one of them."""
        c = bisect_right(self.first, x) - 1
        if c < 0:
            return None, self.first[0]
        chunk = self.chunks[c]
        k = bisect_right(chunk, x)
        if k < len(chunk):
            return chunk[k - 1], chunk[k]
        return chunk[-1], self.first[c + 1] if c + 1 < len(self.first) else None

    def add(self, x: int) -> None:
        c = max(bisect_right(self.first, x) - 1, 0)
        chunk = self.chunks[c]
        chunk.insert(bisect_right(chunk, x), x)
        self.first[c] = chunk[0]
        self.size += 1
        if len(chunk) > _CHUNK:
            half = chunk[_CHUNK // 2:]
            del chunk[_CHUNK // 2:]
            self.chunks.insert(c + 1, half)
            self.first.insert(c + 1, half[0])


def new_neighbours(big: Places, small: Places) -> list[tuple[int, int]]:
    """Adds ``small`` to ``big``; the pairs that are neighbours only now."""
    out, xs = [], list(small)
    for n, x in enumerate(xs):
        below, above = big.around(x)
        if below is not None and (n == 0 or xs[n - 1] < below):
            out.append((below, x))
        if above is not None and (n + 1 == len(xs) or xs[n + 1] > above):
            out.append((x, above))
    for x in xs:
        big.add(x)
    return out


def common_prefixes(token: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the order of suffixes with at least ``least`` words in
    common, and how many."""
    n, level = len(token), least.bit_length() - 1
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none, none
    rank, rounds = _ranks(token)
    if len(rounds) <= level:
        return none, none, none
    at = rounds[level][0].astype(np.int64)  # suffixes whose first 2**level words occur again
    order = at[np.argsort(rank[at])]
    a, b = order[:-1], order[1:]
    x, y = a.copy(), b.copy()
    got = np.zeros(len(a), np.int64)
    dense = np.full(n + 1, -1, np.int32)
    for k in range(len(rounds) - 1, -1, -1):
        at, of = rounds[k]
        dense[at] = of
        step = ((dense[x] == dense[y]) & (dense[x] >= 0)).astype(np.int64) << k
        got, x, y = got + step, np.minimum(x + step, n), np.minimum(y + step, n)
        dense[at] = -1
    enough = got >= least
    return a[enough], b[enough], got[enough]


def runs_of(token: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """``start, length, period`` of every run, by start and period.  ``token``
    numbers the words and tells words of different texts apart."""
    least = max(1, -(-min_length * (min_periods - 1) // min_periods))
    a, b, common = common_prefixes(token, least)
    places = np.unique(np.r_[a, b])
    falling = np.argsort(-common, kind="stable")
    parent = list(range(len(places)))
    classes = [Places(p) for p in places.tolist()]
    seeds: list[tuple[int, int, int]] = []
    ends = (np.searchsorted(places, s[falling]).tolist() for s in (a, b))
    for i, j, l in zip(*ends, common[falling].tolist()):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        while parent[j] != j:
            parent[j] = j = parent[parent[j]]
        if classes[i].size < classes[j].size:
            i, j = j, i
        parent[j] = i
        for left, right in new_neighbours(classes[i], classes[j]):
            p = right - left
            if p * (min_periods - 1) <= l and p + l >= min_length:
                seeds.append((left, p + l, p))
        classes[j] = None
    found = np.array(seeds, np.int64).reshape(-1, 3)
    start, period = found[:, 0], found[:, 2]
    longer = (start > 0) & (token[start - 1] == token[start + period - 1]) if len(found) else start > 0
    found = found[~longer]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: those in no run behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def _structs(rows: np.ndarray, missing: np.ndarray | None = None) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(rows[:, k], pa.int64()) for k in range(3)], names=RUN.names,
                                      mask=None if missing is None else pa.array(missing))


def measure(texts: list[str], min_length: int, min_periods: int) -> list[pa.Array]:
    """Words, runs, the strongest run and the collapsed text of each text."""
    number = _Number()
    words = [t.encode().split() for t in texts]  # bytes split at ASCII white space only
    count = np.fromiter(map(len, words), np.int64, len(words))
    flat = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words]
    doc = np.repeat(np.arange(len(texts)), count)
    token = (np.concatenate(flat) if flat else np.zeros(0, np.int64)) + doc * (len(number) + 1)
    runs = runs_of(token, min_length, min_periods)
    stays = collapsed(len(token), runs)
    begin = np.r_[0, np.cumsum(count)]
    at = np.searchsorted(runs[:, 0], begin)  # a text's runs lie between its first and last place
    runs[:, 0] -= np.repeat(begin[:-1], np.diff(at))
    best = np.zeros((len(texts), 3), np.int64)
    left = []
    for d, w in enumerate(words):
        if at[d] < at[d + 1]:
            best[d] = min(runs[at[d]:at[d + 1]].tolist(), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            w = [x for x, s in zip(w, stays[begin[d]:begin[d + 1]].tolist()) if s]
        left.append(b" ".join(w).decode())
    return [pa.array(count), pa.ListArray.from_arrays(pa.array(at, pa.int32()), _structs(runs)),
            _structs(best, at[:-1] == at[1:]), pa.array(left, pa.string())]


def periodic_runs(df: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
                  keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (start, length and period of every run
    of at least ``min_length`` words and ``min_periods`` periods, by start and
    period), ``strongest`` (the run of most periods, ties to the smallest
    start, then period; null without a run) and ``collapsed_text`` (the words
    in no run behind its first period, joined by one space); ``keep`` names the
    columns to carry along (default: all)."""
    if min_periods < 2 or min_length < 2:
        raise ValueError("a run has at least two periods and two words")
    added = [T.StructField("n_words", T.LongType(), False), T.StructField("runs", T.ArrayType(RUN, False), False),
             T.StructField("strongest", RUN), T.StructField("collapsed_text", T.StringType(), False)]
    names = [f.name for f in added]
    keep = clashes(df.select(*map(quoted, keep)) if keep is not None else df, names)
    schema = schema_of(df, keep, added)
    needed = list(dict.fromkeys([*keep, text_col]))
    at, kept = needed.index(text_col), [needed.index(c) for c in keep]

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(at))
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in kept] + measure(texts[a:b], min_length, min_periods),
                    names=[*keep, *names])

    return numbered(df, needed).mapInArrow(run, schema)
