"""Splittable CSV against Spark's own multi-line reader."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tomewise.sources import datasets as IO
from tomewise.sources import quoted_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("the text", T.StringType()),
                       T.StructField("n.x", T.IntegerType())])


def own_reader(spark, path, schema=SCHEMA):
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
            .schema(schema).csv(path))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, text):
    path = path.removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def field(rng):
    words = ["word", "a,b", 'say ""hi""', "two\nlines", "\n", "", '""', "é€", "  spaces  ", "end\n\n\nof text", "x" * 200]
    return "".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(0, 6)))


def test_quotes_and_breaks_like_the_own_reader(spark, scratch, small_splits):
    for seed, end in ((1, "\n"), (2, "\r\n"), (3, "\n")):
        rng = random.Random(seed)
        lines = ["id,the text,n.x"]
        for i in range(300):
            lines.append(f'{i},"{field(rng)}",{rng.choice(["", "7", "-1", "x"])}')
            if rng.random() < 0.1:
                lines.append("")
            if rng.random() < 0.2:
                lines.append(f"{i},plain words,3")
        if end == "\r\n":
            lines = [x.replace("\n", "\r\n") for x in lines]
        path = write(f"{scratch}/{seed}.csv", end.join(lines) + (end if seed != 3 else ""))
        got = quoted_csv.read(spark, path, SCHEMA)
        assert got.schema == SCHEMA and got.rdd.getNumPartitions() > 10
        assert rows(got) == rows(own_reader(spark, path)) and got.count() > 300


def test_records_longer_than_splits(spark, scratch, small_splits):
    long = "\n".join(f"line {i}, with a comma" for i in range(400))
    path = write(f"{scratch}/a.csv", f'id,the text,n.x\n1,"{long}",2\n2,"{"z" * 5000}",3\n3,"{long}{long}",4\n4,short,5\n')
    assert rows(quoted_csv.read(spark, path, SCHEMA)) == [(1, long, 2), (2, "z" * 5000, 3), (3, long + long, 4),
                                                         (4, "short", 5)]


def test_an_unclosed_quote_takes_the_rest(spark, scratch, small_splits):
    rest = "\n".join(f"{i},never closed,1" for i in range(200))
    path = write(f"{scratch}/a.csv", f'id,the text,n.x\n1,"fine",2\n2,"open\n{rest}')
    assert rows(quoted_csv.read(spark, path, SCHEMA)) == rows(own_reader(spark, path))


def test_headers_of_several_files(spark, scratch, small_splits):
    for i in range(3):
        body = "\n".join(f'{k},"a\nb{k}",{i}' for k in range(i * 100, i * 100 + 80))
        write(f"{scratch}/in/{i}.csv", 'id,"the\ntext",n.x\n' + body + "\n")
    write(f"{scratch}/in/only-header.csv", "id,the text,n.x\n")
    write(f"{scratch}/in/empty.csv", "")
    write(f"{scratch}/in/long-header.csv", 'id,"' + "h\n" * 2000 + '",n.x\n999,"z",1\n')
    path = f"{scratch}/in".removeprefix("file:")
    got = rows(quoted_csv.read(spark, path, SCHEMA))
    assert got == rows(own_reader(spark, path)) and len(got) == 241
    assert len(rows(quoted_csv.read(spark, f"{path}/0.csv", SCHEMA, header=False))) == 81


def test_blocks_are_flushed(spark, monkeypatch):
    """Whole records leave a block before it ends; what is open waits."""
    import pyarrow as pa
    rng = random.Random(4)
    records = [f'{i},"{field(rng)}"' for i in range(200)]
    lines = "\n".join(["head", *records]).split("\n")
    monkeypatch.setattr(quoted_csv, "_FLUSH", 50)

    def batches(part, opened, size):
        for k in range(0, len(part), size):
            own = part[k:k + size]
            yield pa.RecordBatch.from_arrays([
                pa.array(["f"] * len(own)), pa.array([0] * len(own), pa.int64()), pa.array([9] * len(own), pa.int64()),
                pa.array([opened] * len(own), pa.int32()), pa.array([False] * len(own)), pa.array(own)], names=list("abcdef"))

    for size in (1, 3, 1000):
        got = [t for b in quoted_csv._records(False, True)(batches(lines, 0, size)) for t in b.column(4).to_pylist()]
        assert got == records
        # as if the block began inside a quoted field and ended inside another
        part = ['tail one', 'tail two",1', *lines[1:], '7,"open', "still open"]
        whole = [t for b in quoted_csv._records(False, False)(batches(part, 1, size)) for t in b.column(4).to_pylist()]
        edges = [(c, t) for b in quoted_csv._records(True, False)(batches(part, 1, size))
                 for c, t in zip(b.column(2).to_pylist(), b.column(4).to_pylist())]
        assert whole == records
        assert edges == [(True, 'tail one\ntail two",1'), (False, '7,"open\nstill open')]
        mid = [(c, t) for b in quoted_csv._records(True, False)(batches(["all", "inside"], 1, size))
               for c, t in zip(b.column(2).to_pylist(), b.column(4).to_pylist())]
        assert mid == [(True, "all\ninside")]


def test_other_splits_than_before_are_an_error(spark, scratch, small_splits):
    path = write(f"{scratch}/a.csv", "id,the text,n.x\n" + "\n".join(f'{i},"a\nb",1' for i in range(1000)))
    df = quoted_csv.read(spark, path, SCHEMA)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    with pytest.raises(Exception, match="read it again"):
        df.count()


def test_without_a_schema(spark, scratch):
    path = write(f"{scratch}/a.csv", 'id,the text,x\n1,"a\nb",0.5\n2,NA,\n')
    got = IO.read_csv(spark, path)
    assert got.dtypes == [("id", "int"), ("the text", "string"), ("x", "double")]
    assert rows(got) == [(1, "a\nb", 0.5), (2, None, None)]


def test_what_a_worker_holds_depends_on_neither_block_nor_batch(monkeypatch):
    rng = random.Random(5)

    def batches(n, lines):
        for b in range(n):
            texts = [f'{b * lines + i},"{"words, and " * 300}",{i % 7}' for i in range(lines)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(["f"] * lines), pa.array([0] * lines, pa.int64()), pa.array([1] * lines, pa.int64()),
                 pa.array([0] * lines, pa.int32()), pa.array([False] * lines), pa.array(texts)],
                names=["_file", "_start", "_size", "_open", "_crlf", "value"])

    def most(n, lines):
        before, held, rows = pa.total_allocated_bytes(), 0, 0
        for out in quoted_csv._records(False, False)(batches(n, lines)):
            held, rows = max(held, pa.total_allocated_bytes() - before), rows + out.num_rows
        assert rows == n * lines
        return held

    assert most(80, 400) < 16 << 20  # 100 MB of lines, in small batches
    assert most(3, 10_000) < 3 * (33 << 20)  # 33 MB each: this batch and the one before it, hardly more

    # any size of portion gives the same records, also where a record is longer
    lines = [x for i in range(400) for x in f'{i},"{field(rng)}",{rng.randint(0, 9)}'.split("\n")]
    one = pa.RecordBatch.from_arrays(
        [pa.array(["f"] * len(lines)), pa.array([0] * len(lines), pa.int64()), pa.array([1] * len(lines), pa.int64()),
         pa.array([0] * len(lines), pa.int32()), pa.array([False] * len(lines)), pa.array(lines)],
        names=["_file", "_start", "_size", "_open", "_crlf", "value"])

    def texts(flush):
        monkeypatch.setattr(quoted_csv, "_FLUSH", flush)
        return [x for out in quoted_csv._records(False, True)([one.slice(0, 100), one.slice(100)])
                for x in out.column("_text").to_pylist()]

    assert texts(1) == texts(100) == texts(3000) == texts(32 << 20) and len(texts(100)) == 399
