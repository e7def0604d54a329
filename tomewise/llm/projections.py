"""Near-duplicate vectors by collision counting on one-dimensional projections.

Vectors of one label are scaled to length one and projected on random Gaussian
directions.  Two vectors at cosine c differ on a direction by a normal variable
of standard deviation sqrt(2 - 2c), whatever the data, so for a pair at the
least cosine wanted every probability below is known and closer pairs only gain.

Counting: the rows of a group are sorted on each of ``N_COUNTED`` directions, a
window is laid around every row, and per pair the windows that hold both are
counted.  A pair is verified if its count reaches the largest count that keeps
the share ``COUNT_RECALL`` of pairs at the least cosine (a binomial tail).
Verifying is the exact cosine in doubles, so no pair below the bound links.

Grouping: one window in one dimension holds a fixed share of all rows, so
counting over a whole label would touch a fixed share of all its pairs.  Rows
are therefore first dealt to groups by slabs: a table cuts each of its own
directions into slabs of one width at a random offset, and a group is a cell of
these slabs.  The number of directions grows with the logarithm of the largest
label, so that unrelated rows in a cell stay about ``CELL_ROWS``, and the
number of tables is the least at which a pair at the least cosine shares a cell
with probability ``TABLE_RECALL``.  A pair is used in the first table in which
it shares a cell only.  Cells above ``MAX_CELL`` rows are dealt into parts and
every two parts meet in a group of their own, so no row of a crowded cell is
left out and no group is unbounded.

Equal vectors of a label are one representative with a number of copies and
are never paired among themselves.  A group gives back per row the sum of its
partners' copies and a spanning forest of its links, never the pairs, so what
is shuffled stays proportional to the rows; components follow from the forests.

Defined results: rows with a null id, label, vector or component, with a
non-finite component or with a zero or empty vector link with nothing; vectors
of different lengths have no cosine and do not link; every other row of an
equal id and vector is a copy like any other; a row without an id has no
component and stays.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.llm.batches import quoted
from tomewise.llm.graphs import Forest, components
from tomewise.operators.joins import broadcast_if_bounded, join_once
from tomewise.session import reliable

MIN_COSINE = 0.93
SEED = 13
# Counted directions, half a window in standard deviations of a pair at the
# least cosine, and the share of such pairs that the count must keep.
N_COUNTED = 16
WINDOW = 1.5
COUNT_RECALL = 0.999
# Width of a slab on the unit sphere, rows of a cell, and the share of pairs at
# the least cosine that some table must bring together.
SLAB = 2.0
CELL_ROWS = 128
MIN_SLABS = 4
TABLE_RECALL = 0.995
# Rows of a group at most (two parts of a crowded cell have half of it each).
MAX_CELL = 2_048
# Components and directions are rounded to these fractions before they are
# multiplied, so a projection is an exact sum and a row's cells are the same
# wherever they are computed.
_UNIT, _DIRECTION = 2.0**20, 2.0**12


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def same_slab(distance: float, slab: float) -> float:
    """Probability that two points at ``distance`` fall in one slab."""
    r = slab / distance
    return 2 * _normal(r) - 1 - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def count_needed(n: int, p: float, recall: float) -> int:
    """The largest count that a binomial variable reaches with probability ``recall``."""
    tail, count = 0.0, n
    while count > 0:
        tail += math.comb(n, count) * p**count * (1 - p) ** (n - count)
        if tail >= recall:
            return count
        count -= 1
    return 0


class Plan:
    """What a search does, from the least cosine and the largest label."""

    def __init__(self, min_cosine: float, largest: int, seed: int = SEED):
        self.min_cosine, self.seed = min_cosine, seed
        near = math.sqrt(max(2 - 2 * min_cosine, 1e-12))
        self.window = WINDOW * near
        self.needed = count_needed(N_COUNTED, 2 * _normal(WINDOW) - 1, COUNT_RECALL)
        apart = same_slab(math.sqrt(2), SLAB)  # unrelated vectors stand at right angles
        self.slabs = max(MIN_SLABS, math.ceil(math.log(max(largest / CELL_ROWS, 1)) / -math.log(apart)))
        together = same_slab(near, SLAB) ** self.slabs
        self.tables = max(1, math.ceil(math.log(1 - TABLE_RECALL) / math.log(1 - together))) if together < 1 else 1

    def directions(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Directions of the tables, offsets of their slabs, counted directions."""
        return _directions(self.seed, width, self.tables * self.slabs)

    def cells(self, unit: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """A number per row and table that tells table, label, length and cell."""
        tables, offsets, _ = self.directions(unit.shape[1])
        slab = np.floor(np.rint(unit * _UNIT) @ tables / (_UNIT * _DIRECTION * SLAB) + offsets).astype(np.int64)
        cell = labels.view(np.uint64)[:, None] ^ np.array(
            [number_of(f"{t} {unit.shape[1]}") for t in range(self.tables)], np.int64).view(np.uint64)
        for k in range(self.slabs):  # a clash of two cells costs time, not links
            cell = (cell ^ slab[:, k::self.slabs].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            cell ^= cell >> np.uint64(29)
        return cell.view(np.int64)


@lru_cache(maxsize=8)
def _directions(seed: int, width: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, width])
    counted = rng.standard_normal((width, N_COUNTED))
    return np.rint(rng.standard_normal((width, n)) * _DIRECTION), rng.random(n), counted


@lru_cache(maxsize=65_536)
def number_of(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text, SEED) - 2**63


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for very large and very small components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def collisions(group: np.ndarray, asks: np.ndarray, answers: np.ndarray, counted: np.ndarray, window: float,
               needed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a row that asks, a row that answers) of one group that share at
    least ``needed`` windows.  ``group`` numbers the rows' groups, ascending
    from 0; ``counted`` has a column per direction."""
    n = np.bincount(group[answers], minlength=group[-1] + 1)
    place = np.arange(len(group))
    place[answers] = np.arange(len(answers)) - (np.cumsum(n) - n)[group[answers]]
    room = n[group[asks]]
    at = np.cumsum(room) - room  # where the counts of a row that asks begin
    counts = np.zeros(int(room.sum()), np.uint8)
    apart = 4 * np.abs(counted).max() + 4 * window + 1  # groups lie apart on the line
    for h in counted.T:
        line = group * apart + h
        order = answers[np.argsort(line[answers], kind="stable")]
        sorted_line = line[order]
        first = np.searchsorted(sorted_line, line[asks] - window, "left")
        met = np.searchsorted(sorted_line, line[asks] + window, "right") - first
        j = np.arange(met.sum()) - np.repeat(np.cumsum(met) - met - first, met)
        counts[np.repeat(at, met) + place[order[j]]] += 1  # a pair meets at most once in a direction
    hit = np.flatnonzero(counts >= needed)
    row = np.searchsorted(at, hit, "right") - 1
    begin = (np.cumsum(n) - n)[group[asks[row]]]
    return asks[row], answers[begin + hit - at[row]]


def _by_length(lists: pa.Array):
    """``places, rows`` of the lists of each length, the rows as a matrix."""
    flat = np.asarray(lists.flatten(), np.float64)
    size = np.asarray(pa.compute.list_value_length(lists), np.int64)
    begin = np.cumsum(size) - size
    for length in np.unique(size).tolist():
        at = np.flatnonzero(size == length)
        yield at, flat[begin[at][:, None] + np.arange(length)]


def _numbers(labels: pa.Array) -> np.ndarray:
    return np.array([number_of(x) for x in labels.to_pylist()], np.int64)


def _cells(reps: DataFrame, plan: Plan, carry: list[str]) -> DataFrame:
    """``cell`` and the columns ``carry``, a row per representative and table."""
    schema = T.StructType([T.StructField("cell", T.LongType(), False), *[reps.schema[c] for c in carry]])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cells = np.zeros((batch.num_rows, plan.tables), np.int64)
                labels = _numbers(batch.column(0))
                for at, rows in _by_length(batch.column(1)):
                    cells[at] = plan.cells(unit_rows(rows), labels[at])
                for t in range(plan.tables):
                    yield pa.RecordBatch.from_arrays([pa.array(cells[:, t]), *batch.columns[2:]], names=["cell", *carry])

    return reps.select("label", "vector", *carry).mapInArrow(run, schema)


_GROUP = ["cell", "low", "high"]


def _grouped(reps: DataFrame, plan: Plan, max_cell: int) -> DataFrame:
    """Every representative once per table, in the groups of its cell: the
    whole cell, or for a crowded one its part with every part."""
    large = _cells(reps, plan, []).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_cell).select(
        "cell", F.ceil(F.col("n") / (max_cell / 2)).cast("int").alias("parts"))
    large = reliable(large)
    rows = _cells(reps, plan, ["node", "label", "copies", "vector"])
    if large.isEmpty():
        return rows.select("cell", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("part"),
                           "node", "label", "copies", "vector")
    parts = F.coalesce("parts", F.lit(1))
    return (rows.join(broadcast_if_bounded(large), "cell", "left")
            .withColumn("part", F.pmod(F.xxhash64("node", "cell"), parts).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .select("cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part",
                    "node", "label", "copies", "vector"))


# Pairs that are counted at a time.
_COUNTS = 4_000_000


def _links(rows: pa.Table, plan: Plan) -> pa.Table:
    """Per linked row of whole groups, sorted, the copies of its partners and a
    node of its group that it is tied to."""
    node, copies, part, cell, low, high = (rows.column(c).to_numpy() for c in (
        "node", "copies", "part", "cell", "low", "high"))
    labels = rows.column("label").combine_chunks()
    numbers, code = _numbers(labels), labels.dictionary_encode().indices.to_numpy()
    fresh = np.r_[True, (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
    degree, pairs = np.zeros(len(node), np.int64), [np.zeros((2, 0), np.int64)]
    for at, vectors in _by_length(rows.column("vector").combine_chunks()):
        unit = unit_rows(vectors)
        cells = plan.cells(unit, numbers[at])
        table = (cells == cell[at][:, None]).argmax(axis=1)
        counted = unit @ plan.directions(unit.shape[1])[2]
        of = np.unique(np.cumsum(fresh)[at], return_inverse=True)[1]
        cost = np.cumsum(np.bincount(of).astype(np.int64) ** 2)
        for turn in np.unique(cost // _COUNTS).tolist():  # whole groups; one alone is bounded
            some = np.flatnonzero((cost // _COUNTS == turn)[of])
            group = of[some] - of[some[0]]
            asks, answers = (np.flatnonzero(part[at[some]] == side[at[some]]) for side in (low, high))
            i, j = collisions(group, asks, answers, counted[some], plan.window, plan.needed)
            i, j = some[i], some[j]
            x, y = at[i], at[j]
            wanted = (code[x] == code[y]) & ((i < j) | (low[x] != high[x]))
            i, j = i[wanted], j[wanted]
            for a in range(0, len(i), 65_536):
                x, y = i[a:a + 65_536], j[a:a + 65_536]
                # of all tables in which the two meet, the first one counts
                once = (cells[x] == cells[y]).argmax(axis=1) == table[x]
                x, y = x[once], y[once]
                near = np.einsum("ij,ij->i", unit[x], unit[y]) >= plan.min_cosine
                x, y = at[x[near]], at[y[near]]
                np.add.at(degree, x, copies[y])
                np.add.at(degree, y, copies[x])
                pairs.append(np.stack([x, y]))
    forest = Forest(len(node))
    forest.link(*np.concatenate(pairs, axis=1))
    tied = np.flatnonzero(degree)
    return pa.table([pa.array(node[tied]), pa.array(node[forest.roots()[tied]]), pa.array(degree[tied])],
                    names=["a", "b", "n"])


def _found(grouped: DataFrame, plan: Plan) -> DataFrame:
    """``a, b, n``: per group and linked node, a node that it is tied to and the
    copies of its partners.  Many small groups share a batch; a group is bounded."""
    def run(batches):
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
            if not rows.num_rows:
                continue
            keys = [rows.column(c).to_numpy() for c in _GROUP]
            last = int(np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])[-1])
            whole, rest = rows.slice(0, last), rows.slice(last)  # the last group may go on
            if last:
                yield from _links(whole, plan).to_batches()
        if rest is not None and rest.num_rows:
            yield from _links(rest, plan).to_batches()

    return grouped.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(run, "a long, b long, n long")


def near_duplicates(df: DataFrame, id_col: str = "id", vector_col: str = "embedding", label_col: str = "label",
                    min_cosine: float = MIN_COSINE, max_cell: int = MAX_CELL, seed: int = SEED) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row: the number of other
    rows at ``min_cosine`` or more of its label found, the smallest id that
    chains of links reach, and whether that is the row's own.  Ids are longs,
    vectors arrays of floats or doubles, labels of any type that casts to text."""
    if not 0 < min_cosine < 1:
        raise ValueError("min_cosine must lie between 0 and 1")
    v = F.col(quoted(vector_col))
    whole = (F.col(quoted(id_col)).isNotNull() & F.col(quoted(label_col)).isNotNull() & v.isNotNull()
             & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists(v, lambda x: x != 0))
    label = F.col(quoted(label_col)).cast("string")
    plain = F.transform(v, lambda x: x.cast("double") + 0.0)  # minus zero is zero
    rows = df.select(F.col(quoted(id_col)).cast("long").alias("id"), label.alias("label"), v.alias("vector"), F.when(
        whole, F.sha2(F.to_json(F.struct(label.alias("l"), plain.alias("v"))), 256)).alias("digest"))
    reps = reliable(rows.where("digest is not null").groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("label").alias("label"),
        F.first("vector").alias("vector")).withColumn("node", F.monotonically_increasing_id()))
    largest = reps.groupBy("label").count().agg(F.max("count")).head()[0] or 0
    plan = Plan(min_cosine, largest, seed)
    found = reliable(_found(_grouped(reps, plan, max_cell), plan))
    linked = found.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "node")
    tied = components(found.select("a", "b"))
    known = (reps.select("node", "digest", "copies", "least").join(linked, "node", "left").join(tied, "node", "left")
             .where("n is not null or copies > 1")
             .select("digest", "least", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "node").alias("root")))
    known = reliable(known)
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = join_once(known.drop("least"), named, "root").select("digest", "n_links", "component_id")
    out = join_once(rows.select("id", "digest"), known, "digest", "left").select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
