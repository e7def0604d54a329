"""Splittable reading of CSV whose quoted fields hold line breaks.

Spark reads such a file in one task, because a line break does not tell whether
a record ends.  Here physical lines are read, which split anywhere, and quotes
decide: a line begins a record if the quotes before it in its file are even in
number (a doubled quote keeps the parity).

1. The quotes of every block of a file (what one task reads of it) are counted
   by an aggregate, and a running sum over the blocks tells which begin inside
   a quoted field.
2. Each task joins the lines of its blocks to records, a block after the other
   in the order in which they are read; nothing is shuffled.
3. Records that cross the edges of blocks come as pieces, at most two per
   block, and are joined by a small aggregate; without open edges this step is
   left out.
4. ``from_csv`` parses the records.

Lines end in ``\\n`` or, if a file's first line does, in ``\\r\\n``, which then
reads as ``\\n`` inside quoted fields too; a bare quote inside an unquoted field
would count as a quote.  The input is split once more when the result is
computed; if that gives other blocks than before (settings or the cluster's size
changed in between), the job fails and says so, and the file is to be read again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.operators.joins import MAX_BROADCAST_ROWS
from tomewise.session import reliable

_BLOCK = ["_file", "_start", "_size"]
_LINES = "_file string, _start bigint, _continues boolean, _header boolean, _text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines and the block that each is in, in the order of the block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_block_length").alias("_size"), "value")


def _blocks(lines: DataFrame) -> DataFrame:
    """Whether each block begins, and whether it ends, inside a quoted field,
    and whether its file's lines end in ``\\r\\n`` (as its first line does)."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    per = lines.groupBy(*_BLOCK).agg(
        (F.sum(quotes) % 2).alias("_odd"), F.first(F.endswith("value", F.lit("\r"))).alias("_first"))  # one task has a block
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)  # a file's blocks
    opened = (F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2).cast("int")
    crlf = F.bool_or((F.col("_start") == 0) & F.col("_first")).over(Window.partitionBy("_file"))
    return reliable(per.select(*_BLOCK, opened.alias("_open"), ((opened + F.col("_odd")) % 2 == 1).alias("_ends_open"),
                               crlf.alias("_crlf")))


# Lines are joined as soon as about so many bytes of a block have been read, so
# what a worker holds depends on neither its block's size nor Arrow's batches.
_FLUSH = 2 << 20


def _portions(lines: pa.Array):
    """``lines`` in slices of about ``_FLUSH`` bytes."""
    step = max(1, len(lines) * _FLUSH // max(1, lines.nbytes))
    return (lines.slice(at, step) for at in range(0, len(lines), step))


class _Block:
    """The lines of a block, read so far, as texts: whole records, and the
    pieces at its edges."""

    def __init__(self, file: str, start: int, opened: int, crlf: bool, header: bool):
        self.file, self.start, self.crlf, self.header = file, start, crlf, header and start == 0
        self.lines, self.open, self.continues = [], opened, opened == 1
        self.size, self.limit = 0, _FLUSH

    def add(self, lines: pa.Array) -> bool:
        self.lines.append(lines)
        self.size += lines.nbytes
        return self.size >= self.limit

    def texts(self, pieces: bool, end: bool):
        """Batches of whole records, or of pieces; the last record waits for
        more lines unless the block ends."""
        lines = pa.concat_arrays(self.lines)
        quotes = np.asarray(pc.count_substring(lines, '"'), np.int64)
        before = (self.open + np.cumsum(quotes) - quotes) % 2
        begins = np.flatnonzero((before == 0) | (np.arange(len(lines)) == 0))
        if not end:
            last = int(begins[-1])
            lines, self.lines, self.open = lines[:last], [lines[last:]], int(before[last])
            begins = begins[:-1]
            self.size = self.lines[0].nbytes
            self.limit = max(_FLUSH, 2 * self.size)  # a long record is not joined anew with every portion
            if not last:
                return
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[begins, len(lines)], pa.int32()), lines), "\n")
        if self.crlf:
            texts = pc.replace_substring_regex(pc.replace_substring(texts, "\r\n", "\n"), "\\r\\z", "")
        first, beyond = 0, len(texts)
        if self.continues:
            if pieces:
                yield self._batch(texts[:1])
            first, self.continues = 1, False
        title, self.header = self.header and first < beyond, self.header and first >= beyond
        if end and (self.open + quotes.sum()) % 2 == 1 and first < beyond:
            if pieces:
                yield self._batch(texts[beyond - 1:], title and first == beyond - 1)
            beyond -= 1
        first += title
        if not pieces and first < beyond:
            yield self._batch(texts[first:beyond])

    def _batch(self, texts: pa.Array, title: bool = False) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.file] * n, pa.string()), pa.array([self.start] * n, pa.int64()),
             pa.array([self.continues] * n, pa.bool_()), pa.array([title] * n, pa.bool_()), texts],
            names=["_file", "_start", "_continues", "_header", "_text"])


def _records(pieces: bool, header: bool):
    """A function over batches of lines with their block and its state: whole
    records as ``_text``, or the pieces of those that cross a block's edge."""
    def run(batches):
        block = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column(3).null_count:
                raise RuntimeError("the input is split into other blocks than when it was opened; read it again")
            code = batch.column(0).dictionary_encode().indices.to_numpy()
            start = batch.column(1).to_numpy()
            edges = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (start[1:] != start[:-1])]).tolist()
            for a, b in zip(edges, [*edges[1:], batch.num_rows]):
                file, at = batch.column(0)[a].as_py(), int(start[a])
                if block is None or (block.file, block.start) != (file, at):
                    if block is not None:
                        yield from block.texts(pieces, True)
                    block = _Block(file, at, batch.column(3)[a].as_py(), batch.column(4)[a].as_py(), header)
                for lines in _portions(batch.column(5).slice(a, b - a)):
                    if block.add(lines):
                        yield from block.texts(pieces, False)
        if block is not None:
            yield from block.texts(pieces, True)

    return run


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The records of the CSV files at ``path`` as texts ``_text``, without
    each file's header and without empty lines."""
    lines = _lines(spark, path)
    blocks = _blocks(lines)
    edges, n = blocks.agg(F.count_if((F.col("_open") == 1) | F.col("_ends_open")), F.count(F.lit(1))).head()

    def with_state(known: DataFrame, how: str) -> DataFrame:
        numbered = lines if n <= MAX_BROADCAST_ROWS else lines.withColumn("_line", F.monotonically_increasing_id())
        both = numbered.join(F.broadcast(known) if n <= MAX_BROADCAST_ROWS else known, _BLOCK, how)
        if n > MAX_BROADCAST_ROWS:  # the join deals the lines out: back to the order in which they were read
            both = both.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "_line")
        return both.select(*_BLOCK, "_open", "_crlf", "value")

    state = blocks.select(*_BLOCK, "_open", "_crlf")
    texts = with_state(state, "left").mapInArrow(_records(False, header), _LINES).select("_text")
    if edges:
        crossing = blocks.where((F.col("_open") == 1) | F.col("_ends_open")).select(*_BLOCK, "_open", "_crlf")
        pieces = reliable(with_state(crossing, "inner").mapInArrow(_records(True, header), _LINES))
        order = Window.partitionBy("_file").orderBy("_start", F.col("_continues").desc())  # two per block at most
        record = F.sum(F.when(F.col("_continues"), 0).otherwise(1)).over(order)
        whole = pieces.withColumn("_record", record).groupBy("_file", "_record").agg(
            F.sort_array(F.collect_list(F.struct("_start", ~F.col("_continues"), "_text"))).alias("p"),
            F.bool_or("_header").alias("_header"))
        texts = texts.unionByName(whole.where(~F.col("_header")).select(F.concat_ws("\n", F.col("p._text")).alias("_text")))
    return texts.where("_text <> ''")


def read(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The CSV files at ``path`` with the columns of ``schema``, by position."""
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])
    row = F.from_csv(F.col("_text"), plain.simpleString()[len("struct<"):-1].replace(":", " "), options)
    return read_records(spark, path, header).select(row.alias("r")).select(
        *[F.col(f"r.c{i}").alias(f.name) for i, f in enumerate(schema.fields)])
