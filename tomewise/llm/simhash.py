"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint is eight bytes.  Two fingerprints that differ in at most ``k``
bits differ in at most ``k`` bytes, so they share at least ``8 - k`` positional
bytes.  Single bytes give posting lists of 1/256 of all fingerprints; so the
index is keyed by small sets of positions: of ``8 - k`` shared positions at
least half lie in one half of the fingerprint, and with ``r`` the half of
``8 - k``, rounded up, every such pair meets under some key of ``r`` positions
of one half (for three bits: eight keys of 24 bits each).  Under a key, the
shared positional bytes of each pair are tallied, pairs below ``8 - k`` fall
out, and the differing bits of the others are counted.

Only different fingerprints are indexed, each once.  A key's links leave its
task as a spanning forest, never as all pairs.  A key with more than
``max_bucket`` fingerprints passes through and is keyed again by all further
positions that a pair must share; a list under such a key holds at most
``256 ** k`` fingerprints, and a large one is searched by flipping bits instead
of comparing pairs.  Components of the links are found in ``graphs``.

Defined results: a null text counts as a text without words; a text without
words has fingerprint zero, a text with fewer words than a shingle is one
shingle; repeated rows are returned each, with the same component; a null id
takes part but never names a component unless all ids of it are null.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.llm.batches import numbered, slices, texts_of
from tomewise.llm.graphs import Forest, components
from tomewise.operators.joins import join_once
from tomewise.session import reliable

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
MAX_BUCKET = 4_096
# Characters whose texts are fingerprinted at once, and shingles whose bits are
# counted at once (64 bytes each).
_CHARS = 1_000_000
_SHINGLES = 50_000


def _shingles(text: str, n: int) -> list[bytes]:
    words = text.encode().lower().split()  # bytes: only A-Z changes, only ASCII white space splits
    if len(words) <= n:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(n)))))


def fingerprint(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per text from the flat hashes of all its shingles."""
    out = np.zeros(len(counts), np.uint64)
    ones = np.zeros((len(counts), 64), np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    for a in range(0, len(hashes), _SHINGLES):
        part, of = hashes[a:a + _SHINGLES], text[a:a + _SHINGLES]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        ones[of[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    more = (2 * ones > counts[:, None]).astype(np.uint8)
    out[:] = np.packbits(more, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``id, fp`` (the fingerprint's 64 bits as a long) of every row."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("fp", T.LongType(), False)])

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices(texts, _CHARS):
                # the shingles of one text at a time, so that only hashes pile up
                each = [np.fromiter(map(xxhash.xxh64_intdigest, _shingles(t, shingle_words), repeat(seed)), np.uint64)
                        for t in texts[a:b]]
                counts = np.fromiter(map(len, each), np.int64, b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array(fingerprint(np.concatenate(each), counts).view(np.int64))], names=["id", "fp"])

    return numbered(df, [id_col, text_col]).mapInArrow(run, schema)


def _byte(position: int):
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255))


def _key(positions: tuple[int, ...]):
    key = F.lit(0).cast("long")
    for p in positions:
        key = key * 256 + _byte(p)
    return key


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which any pair within ``max_bits`` shares one."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be from 0 to 7")
    r = (8 - max_bits + 1) // 2
    return [*combinations(range(4), r), *combinations(range(4, 8), r)]


def _forest(x: np.ndarray, max_bits: int, max_bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the sorted fingerprints under one key."""
    forest = Forest(len(x))
    if len(x) <= 4 * max_bucket:
        step = max(1, 2_000_000 // len(x))
        for a in range(0, len(x), step):
            differ = x[a:a + step, None] ^ x[None, :]
            shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(-1)
            i, j = np.nonzero(shared >= 8 - max_bits)
            near = np.bitwise_count(differ[i, j]) <= max_bits
            forest.link(i[near] + a, j[near])
    else:
        free = np.bitwise_or.reduce(x ^ x[0])
        bits = [np.uint64(1 << b) for b in range(64) if int(free) >> b & 1]
        for n in range(1, max_bits + 1):
            for some in combinations(bits, n):
                y = x ^ np.bitwise_or.reduce(np.array(some, np.uint64))
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                i = np.flatnonzero(x[at] == y)
                forest.link(i, at[i])
    root = forest.roots()
    i = np.flatnonzero(root != np.arange(len(x)))
    return x[i], x[root[i]]


def _search(keyed: DataFrame, max_bits: int, pass_on: bool, max_bucket: int) -> DataFrame:
    """``again, a, b``: links under each key (``again`` false), and the keys
    and fingerprints of lists longer than ``max_bucket`` if they are passed on.
    ``keyed`` has the columns key (a whole list has one key) and fp."""
    schema = "again boolean, a long, b long"

    def table(again, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), again)), pa.array(a.view(np.int64)),
                                           pa.array(b.view(np.int64))], names=["again", "a", "b"])

    def solve(key, fp, passing):
        """Whole lists, sorted by key; ``passing`` is a key known to be long."""
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.r_[first, len(key)])
        for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
            if pass_on and (n > max_bucket or key[a] == passing):
                yield table(True, key[a:a + n], fp[a:a + n])
            else:
                yield table(False, *_forest(np.unique(fp[a:a + n]), max_bits, max_bucket))
        if passing is not None and len(first) and key[0] == passing and size[0] == 1:
            yield table(True, key[:1], fp[:1])

    def run(batches):
        key, fp, passing = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            key = np.r_[key, batch.column(0).to_numpy()]
            fp = np.r_[fp, batch.column(1).to_numpy().view(np.uint64)]
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield from solve(key[:last], fp[:last], passing)
            key, fp = key[last:], fp[last:]
            if pass_on and len(key) and (len(key) > max_bucket or key[0] == passing):
                passing = key[0]
                yield table(True, key, fp)
                key, fp = key[:0], fp[:0]
        yield from solve(key, fp, passing)

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``a, b``: links between the different fingerprints ``fp``, enough to
    join every two within ``max_bits`` bits through a chain of such pairs."""
    sets = position_sets(max_bits)
    width = 8 * len(sets[0])  # a key's bytes; the set's number comes before them
    keyed = distinct.select(
        F.explode(F.array(*[F.lit(k << width).cast("long") + _key(s) for k, s in enumerate(sets)])).alias("key"), "fp")
    found = reliable(_search(keyed, max_bits, True, max_bucket))
    near = found.where("not again").select("a", "b")
    long = found.where("again").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if long.limit(1).count():
        more = [(k, s + rest) for k, s in enumerate(sets)
                for rest in combinations([p for p in range(8) if p not in s], max(0, 8 - max_bits - len(s)))]
        # number and bytes of a set may not fit a long and are hashed; lists are solved by their
        # fingerprints, so a clash of two keys costs time, not links
        again = F.array(*[F.when(F.shiftright("key", width) == k, F.xxhash64(F.lit(n), _key(s)))
                          for n, (k, s) in enumerate(more)])
        refined = long.select(F.explode(F.filter(again, lambda x: x.isNotNull())).alias("key"), "fp")
        near = near.unionByName(reliable(_search(refined, max_bits, False, max_bucket)).select("a", "b"))
    return near


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``id_col, fingerprint`` (16 hexadecimal digits) and ``component_id``,
    the smallest id that chains of fingerprints within ``max_bits`` reach."""
    prints = reliable(fingerprints(df, id_col, text_col, shingle_words, seed))
    least = reliable(prints.groupBy("fp").agg(F.min("id").alias("least")))
    tied = components(links(least.select("fp"), max_bits, max_bucket))
    rooted = least.join(tied, least["fp"] == tied["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = reliable(join_once(rooted, named, "root").select(_hex("fp").alias("fingerprint"), "component_id"))
    # a fingerprint may be that of a large share of the rows
    return (join_once(prints.select(F.col("id").alias("_id"), _hex("fp").alias("fingerprint")), named, "fingerprint")
            .select(F.col("_id").alias(id_col), "fingerprint", "component_id"))


def _hex(name: str):
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))
