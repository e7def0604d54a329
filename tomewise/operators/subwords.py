"""ML1-ML3 with a learned sub-word vocabulary: no word is ever unknown.

A text is cut at its spaces into pieces, each but the first with the space
before it, and a piece is its UTF-8 bytes, written as hexadecimal pairs.
Learning joins neighbouring symbols of the distinct pieces: each round counts
all pairs by one aggregate, weighted by the pieces' counts, and takes pairs in
order of count (ties by the symbols) that cannot overlap one taken before in the
round, so all of them are applied together and in any order.  Ids: 0..3 special,
then the 256 bytes, then the merges in order.  Encoding applies the rounds to the
distinct pieces of a corpus, in Arrow batches, and joins the texts' pieces with
them; decoding joins ids with the symbols and reads the bytes back, so it gives
every text exactly.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.operators.joins import broadcast_if_bounded, join_once
from tomewise.operators.vocab import N_SPECIAL
from tomewise.session import reliable

FIRST_MERGE = N_SPECIAL + 256
# Most frequent pairs that a round looks at, and occurrences that a merge needs.
PAIRS_PER_ROUND = 512
MIN_COUNT = 2

MERGE_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("round", T.IntegerType()),
    T.StructField("left", T.StringType()), T.StructField("right", T.StringType()), T.StructField("n", T.LongType()),
])


def pieces(text: Column) -> Column:
    """The parts between spaces, each but the first with its space."""
    return F.transform(F.split(text, " ", -1), lambda w, i: F.when(i > 0, F.concat(F.lit(" "), w)).otherwise(w))


def _bytes_of(piece: Column) -> Column:
    """A piece's bytes as hexadecimal pairs; an empty piece has none."""
    return F.filter(F.split(F.regexp_replace(F.hex(F.encode(piece, "UTF-8")), "(..)", "$1 "), " "), lambda s: s != "")


def _join(symbols: list[str], rounds: list[set[tuple[str, str]]]) -> list[str]:
    """The rounds' pairs joined wherever they occur, from left to right."""
    for pairs in rounds:
        out: list[str] = []
        for s in symbols:
            if out and (out[-1], s) in pairs:
                out[-1] += s
            else:
                out.append(s)
        symbols = out
    return symbols


def _merged(df: DataFrame, rounds: list[set[tuple[str, str]]]) -> DataFrame:
    """``df`` (a column, then ``symbols``) with the rounds applied, in Arrow batches."""
    def run(batches):
        for batch in batches:
            joined = pa.array([_join(s, rounds) for s in batch.column(1).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), joined], names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def apart(pairs: list[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """Of pairs in order, those that overlap none taken before, whatever the
    text: no symbol is the right side of one and the left side of another."""
    lefts, rights, out = set(), set(), []
    for a, b, n in pairs:
        if a not in rights and b not in lefts and (a != b or a not in lefts | rights):
            out.append((a, b, n))
            lefts.add(a)
            rights.add(b)
    return out


def _spread(df: DataFrame) -> DataFrame:
    """Distinct pieces are few bytes but long work: all tasks get a share."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def learn_merges(df: DataFrame, text_col: str = "review_text", n_merges: int = 1_000,
                 pairs_per_round: int = PAIRS_PER_ROUND, min_count: int = MIN_COUNT) -> DataFrame:
    """``id, round, left, right, n``: at most ``n_merges`` merges in order.  The
    driver sees the most frequent pairs of a round, ``pairs_per_round`` at most."""
    spark = df.sparkSession
    words = reliable(df.select(F.explode(pieces(F.col(text_col))).alias("piece")).groupBy("piece").agg(
        F.count(F.lit(1)).alias("n")).select("n", _bytes_of(F.col("piece")).alias("symbols")).where(F.size("symbols") > 1)
        .transform(_spread))
    merges: list[tuple] = []
    rounds = 0
    while len(merges) < n_merges:
        s = F.col("symbols")
        both = F.explode(F.arrays_zip(F.slice(s, 1, F.size(s) - 1).alias("a"), F.slice(s, 2, F.size(s)).alias("b")))
        top = (words.select("n", both.alias("p")).groupBy("p.a", "p.b").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= min_count).orderBy(F.col("n").desc(), "a", "b").limit(pairs_per_round).collect())
        chosen = apart([tuple(r) for r in top])[:n_merges - len(merges)]
        if not chosen:
            break
        merges += [(FIRST_MERGE + len(merges) + k, rounds, a, b, n) for k, (a, b, n) in enumerate(chosen)]
        rounds += 1
        if len(merges) < n_merges:
            words = reliable(_merged(words, [{(a, b) for a, b, _ in chosen}]).where(F.size("symbols") > 1))
    return spark.createDataFrame(merges, MERGE_SCHEMA)


def symbols(spark: SparkSession, merges: DataFrame) -> DataFrame:
    """``id, symbol`` of the bytes and the merges."""
    own = spark.range(256).select((F.col("id") + N_SPECIAL).cast("int").alias("id"),
                                  F.lpad(F.hex("id"), 2, "0").alias("symbol"))
    return own.unionByName(merges.select("id", F.concat("left", "right").alias("symbol")))


def encode(df: DataFrame, merges: DataFrame, text_col: str = "review_text", key: str = "review_id") -> DataFrame:
    """``key, input_ids`` of every text; ``key`` must name the rows.  A null
    text has null ids."""
    rounds: dict[int, set] = {}
    for r in merges.collect():  # as many rows as merges were asked for
        rounds.setdefault(r["round"], set()).add((r["left"], r["right"]))
    placed = df.select(key, F.posexplode_outer(pieces(F.col(text_col))).alias("at", "piece"))
    split = _spread(placed.where("piece is not null").select("piece").distinct()).select(
        "piece", _bytes_of(F.col("piece")).alias("_s"))
    split = _merged(split, [rounds[r] for r in sorted(rounds)])
    known = broadcast_if_bounded(symbols(df.sparkSession, merges))
    coded = split.select("piece", F.posexplode_outer("_s").alias("k", "symbol")).join(known, "symbol", "left").groupBy("piece").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "id")))), lambda x: x.id).alias("ids"))
    # a frequent piece is that of a large share of the rows
    rows = join_once(placed, coded, "piece", "left").groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "ids")))).alias("p"))
    return rows.select(key, F.when(F.size("p") > 0, F.flatten(F.col("p.ids"))).alias("input_ids"))


def decode(encoded: DataFrame, merges: DataFrame, key: str = "review_id", ids_col: str = "input_ids") -> DataFrame:
    """``key, text``: the texts again, byte for byte; special ids are skipped."""
    known = broadcast_if_bounded(symbols(encoded.sparkSession, merges))
    placed = encoded.select(key, F.col(ids_col).isNull().alias("_none"),
                            F.posexplode_outer(F.filter(ids_col, lambda i: i >= N_SPECIAL)).alias("at", "id"))
    rows = placed.join(known, "id", "left").groupBy(key, "_none").agg(
        F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "symbol")))).alias("p"))
    text = F.decode(F.unhex(F.array_join(F.col("p.symbol"), "")), "UTF-8")
    return rows.select(key, F.when(~F.col("_none"), text).alias("text"))
