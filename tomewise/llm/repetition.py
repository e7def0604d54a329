"""Repetition inside a text from a suffix array of its words.

The words of many texts lie in one flat array; suffixes are ordered by
prefix doubling (the rank of 2h words follows from the ranks of h words and of
the h words after them), and a suffix leaves the sort as soon as its first h
words occur nowhere else in its text, so ordinary prose is done after a few
rounds.  The ranks of each round also give the longest common prefix of
neighbouring suffixes.  A suffix's deepest common-prefix interval has the
larger of its two neighbouring prefixes as its length: that is the longest
repeated substring that begins there, and it is a maximal one unless the
suffix before it carries the same repeat one word further to the left.  The
spans of all maximal repeats of at least ``min_repeat_words`` words are united.
A text is rejected if they cover too large a share of it, or if one repeat is
too long.  Texts are independent rows, so nothing is shuffled.

Words are runs of characters other than space and \\x09-\\x0D.  Defined
results: a null text is a text without words; repeated rows give repeated
results; added columns replace columns of the same name, others are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tomewise.llm.batches import clashes, numbered, quoted, schema_of, slices, texts_of

# A text is rejected by the base rules below MIN_WORDS words or with more than
# MAX_WINDOW_PERCENT percent of its words in repeated three-word windows.
MIN_WORDS = 50
WINDOW_WORDS = 3
MAX_WINDOW_PERCENT = 50
# The method's own limits: spans of maximal repeats of at least so many words
# may cover so many percent of the words, and no repeat may be longer than so
# many words, or than so many percent of the words where that is more.  The
# good documents of the given 10,000 have 28 % and 13 words at most.
MIN_REPEAT_WORDS = 5
MAX_COVERED_PERCENT = 30
MAX_REPEAT_WORDS = 20
MAX_REPEAT_PERCENT = 2
SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


def _ranks(token: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Rank of every suffix among those with an equal first word, and per
    round the suffixes whose first 2**round words are repeated, with ranks.
    ``token`` tells words of different texts apart."""
    n = len(token)
    order = np.argsort(token, kind="stable")
    fresh = np.r_[True, token[order][1:] != token[order][:-1]]
    begin = np.flatnonzero(fresh)
    size = np.diff(np.r_[begin, n])
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.repeat(begin, size) + 1  # 0: behind the end
    active = order[np.repeat(size > 1, size)]
    rounds, h = [], 1
    while len(active):
        rounds.append((active.astype(np.int32), rank[active].astype(np.int32)))
        behind = rank[np.minimum(active + h, n)]
        key = rank[active] * (n + 2) + behind
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        own = rank[active]
        group = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        first = np.repeat(group, np.diff(np.r_[group, len(active)]))
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[begin, len(active)])
        rank[active] = own + np.repeat(begin, size) - first
        active = active[np.repeat(size > 1, size)]
        h *= 2
    return rank[:n], rounds


def longest_repeats(token: np.ndarray) -> np.ndarray:
    """For each place the number of words of the longest substring that begins
    there and also elsewhere (it may overlap itself)."""
    n = len(token)
    best = np.zeros(n + 1, np.int64)
    if not n:
        return best[:0]
    rank, rounds = _ranks(token)
    order = np.zeros(n + 1, np.int64)
    order[rank] = np.arange(n)
    a, b = order[1:-1].copy(), order[2:].copy()
    common = np.zeros(len(a), np.int64)
    dense = np.full(n + 1, -1, np.int32)
    live = np.arange(len(a))
    if rounds:  # only neighbours with an equal first word have a common prefix
        dense[rounds[0][0]] = rounds[0][1]
        live = np.flatnonzero((dense[a] == dense[b]) & (dense[a] >= 0))
        dense[rounds[0][0]] = -1
    else:
        live = live[:0]
    x, y = a[live], b[live]
    got = np.zeros(len(live), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        at, of = rounds[k]
        dense[at] = of
        equal = (dense[x] == dense[y]) & (dense[x] >= 0)
        step = equal.astype(np.int64) << k
        got, x, y = got + step, np.minimum(x + step, n), np.minimum(y + step, n)
        dense[at] = -1
    common[live] = got
    np.maximum.at(best, a, common)
    np.maximum.at(best, b, common)
    return best[:n]


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


class _Number(dict):
    def __missing__(self, word):
        self[word] = at = len(self)
        return at


def measure(texts: list[str], min_repeat_words: int = MIN_REPEAT_WORDS) -> dict[str, np.ndarray]:
    """The word statistics of each text, as columns."""
    number = _Number()
    words = [t.encode().split() for t in texts]  # bytes split at ASCII white space only
    count = np.fromiter(map(len, words), np.int64, len(words))
    flat = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words]
    doc = np.repeat(np.arange(len(texts)), count)
    token = (np.concatenate(flat) if flat else np.zeros(0, np.int64)) + doc * (len(number) + 1)
    best = longest_repeats(token)
    n = len(token)
    window = np.flatnonzero(best >= WINDOW_WORDS)
    long = best >= min_repeat_words
    maximal = long & ~np.r_[False, (best[:-1] > best[1:]) & (doc[:-1] == doc[1:])][:n]
    spans = np.flatnonzero(maximal)
    per = lambda x: np.bincount(doc, weights=x, minlength=len(texts)).astype(np.int64)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc, best)
    return {
        "n_words": count,
        "word_chars": np.array([len(t) - sum(map(t.count, WHITE)) for t in texts], np.int64),
        "n_symbols": np.array([len(b) - len(b.translate(None, SYMBOLS)) for b in map(str.encode, texts)], np.int64),
        "n_dup_lines": np.array([_equal_lines(t) for t in texts], np.int64),
        "n_repeat_words": per(_covered(window, np.full(len(window), WINDOW_WORDS), n)),
        "n_covered_words": per(_covered(spans, best[spans], n)),
        "n_maximal_repeats": per(maximal),
        "longest_repeat": longest,
    }


def _equal_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


_LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words",
          "n_maximal_repeats", "longest_repeat"]


def repetition_rules(df: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS,
                     max_window_percent: int = MAX_WINDOW_PERCENT, min_repeat_words: int = MIN_REPEAT_WORDS,
                     max_covered_percent: int = MAX_COVERED_PERCENT, max_repeat_words: int = MAX_REPEAT_WORDS,
                     max_repeat_percent: int = MAX_REPEAT_PERCENT, keep: list[str] | None = None) -> DataFrame:
    """``df`` with the statistics of its texts, ``base_failed`` and ``kept``;
    ``keep`` names the columns to carry along (default: all)."""
    added = [*_LONGS, "base_failed", "kept"]
    keep = clashes(df.select(*map(quoted, keep)) if keep is not None else df, added)
    schema = schema_of(df, keep, [T.StructField(c, T.LongType(), False) for c in _LONGS]
                       + [T.StructField(c, T.BooleanType(), False) for c in added[-2:]])
    needed = list(dict.fromkeys([*keep, text_col]))
    at, kept = needed.index(text_col), [needed.index(c) for c in keep]

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(at))
            for a, b in slices(texts):
                m = measure(texts[a:b], min_repeat_words)
                n = m["n_words"]
                failed = (n < min_words) | (100 * m["n_repeat_words"] > max_window_percent * n)
                good = ~failed & (100 * m["n_covered_words"] <= max_covered_percent * n) & (
                    (m["longest_repeat"] <= max_repeat_words)
                    | (100 * m["longest_repeat"] <= max_repeat_percent * n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in kept]
                    + [pa.array(m[c]) for c in _LONGS] + [pa.array(failed), pa.array(good)],
                    names=[*keep, *added])

    return numbered(df, needed).mapInArrow(run, schema)
