"""Best-fit packing of tokenised documents by the sum of squares.

Every document becomes its ids and an end id.  One longer than a sequence is
cut into pieces of full length, of which the first may be shorter.  A full
piece is a sequence of its own; the others are packed, in groups of about
``group_rows`` pieces dealt out evenly.  Within a group the pieces go from the
longest to the shortest, each into the open sequence after which the sum over
all gaps of the squared number of open sequences with that gap is smallest; a
sequence is opened only if no open one has room.  A group's loss is a few
half-empty sequences, so the total loss is a fixed small share at any size.

The pieces are written once with ``checkpoint()``, so groups and sequence
numbers stay the same when an executor is lost.

Defined results: a null text counts as empty and gives one piece that holds
the end id alone; repeated rows are packed each by itself; rows with a null id
keep it; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.llm.batches import numbered, quoted
from tomewise.llm.ids import id_encoder
from tomewise.session import reliable

SEQUENCE_TOKENS = 1024
END_ID = 2
GROUP_ROWS = 32_768


def pieces(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
           sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece`` (from 0), ``start`` (its document's
    ids before it), ``length``, ``ids_crc32`` and, if wanted, ``ids``."""
    fields = [T.StructField(id_col, df.schema[id_col].dataType),
              T.StructField("piece", T.IntegerType(), False), T.StructField("start", T.LongType(), False),
              T.StructField("length", T.LongType(), False), T.StructField("ids_crc32", T.LongType(), False)]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType(), False), False))
    names = [f.name for f in fields]

    def run(batches):
        encode = id_encoder(vocabulary_path)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                n = max(1, math.ceil(len(own) / sequence_tokens))
                edge = len(own) - sequence_tokens * np.arange(n, -1, -1)
                edge[0] = 0
                for k, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(own[a:b]))
                    if with_ids:
                        ids.append(own[a:b].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                + ([pa.array(ids, pa.list_(pa.field("element", pa.int64(), False)))] if with_ids else []),
                names=names)

    return numbered(df, [id_col, text_col]).mapInArrow(run, T.StructType(fields))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, placed by the sum of squares."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)  # open sequences per gap
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        # from gap g = n + k to gap k: the sum of squares grows by 2 (count[k] - count[g] + 1),
        # or by 1 - 2 count[g] where the sequence is filled up
        have = count[n:]
        grows = np.where(have > 0, 2 * (count[:capacity + 1 - n] - have + 1), np.iinfo(np.int64).max)
        if have[0]:
            grows[0] = 1 - 2 * have[0]
        k = int(grows.argmin())
        if have[k]:
            s = open_at[n + k].pop()
            count[n + k] -= 1
        else:
            s, k, opened = opened, capacity - n, opened + 1
        sequence[i], offset[i] = s, capacity - n - k
        if k:
            open_at[k].append(s)
            count[k] += 1
    return sequence, offset


def pack(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
         sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, group_rows: int = GROUP_ROWS,
         with_ids: bool = False) -> DataFrame:
    """The ``pieces`` of all documents with ``sequence_id`` and ``offset``."""
    cut = reliable(pieces(df, vocabulary_path, id_col, text_col, sequence_tokens, end_id, with_ids))
    names = cut.columns
    at = cut.select("*", F.monotonically_increasing_id().alias("_row"))
    full = at.where(F.col("length") == sequence_tokens).select(
        *map(quoted, names), (F.col("_row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = at.where(F.col("length") < sequence_tokens)
    groups = max(1, math.ceil(short.count() / group_rows))
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType(), False),
                           T.StructField("offset", T.LongType(), False)])

    def run(batches):
        got = list(batches)
        if not got:
            return
        group = pa.Table.from_batches(got).sort_by("_row")
        sequence, offset = place(group.column("length").to_numpy(), sequence_tokens)
        base = TaskContext.get().partitionId() << 33
        out = group.drop_columns(["_row"]).append_column("sequence_id", pa.array((base + sequence) * 2 + 1))
        yield from out.append_column("offset", pa.array(offset)).combine_chunks().to_batches()

    packed = short.repartition(groups, "_row").mapInArrow(run, schema)
    return full.unionByName(packed)
