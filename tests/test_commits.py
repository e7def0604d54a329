"""Atomic commits: many writers, a killed writer, snapshots of the manifest."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tomewise.sources import commits
from tomewise.sources import datasets as IO


def test_eight_writers_over_thirty_rounds(spark, scratch):
    """Every round eight writers want the same names: each name goes to one of
    them, whole, and nobody fails."""
    barrier = Barrier(8)

    def write(writer):
        taken = []
        for r in range(30):
            staged = commits.stage(spark, f"{scratch}/d")
            for part in range(2):
                commits.write_text(spark, f"{staged}/part-{part}", f"{writer} {r}")
            n = 1
            barrier.wait()
            while not commits.commit(spark, staged, f"{scratch}/d/version={n}"):
                n += 1
            taken.append(n)
        return writer, taken

    with ThreadPoolExecutor(8) as pool:
        done = dict(pool.map(write, range(8)))
    owner = {n: w for w, ns in done.items() for n in ns}
    assert sorted(owner) == list(range(1, 241))
    for n, w in owner.items():
        r = done[w].index(n)
        assert {commits.read_text(spark, f"{scratch}/d/version={n}/part-{p}") for p in range(2)} == {f"{w} {r}"}


def test_published_versions_hold_one_writer_each(spark, scratch):
    def write(writer):
        return [(IO.publish(spark, spark.range(writer * 10, writer * 10 + 3 + r).withColumn("w", F.lit(writer)), "shared",
                            root=scratch), 3 + r) for r in range(3)]

    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(write, range(8)))
    sizes = {v: (w, n) for w, own in enumerate(done) for v, n in own}
    assert sorted(sizes) == list(range(1, 25))
    rows = {r["version"]: r for r in IO.manifest(spark, "shared", scratch).collect()}
    assert sorted(rows) == sorted(sizes)
    for v, (w, n) in sizes.items():
        d = spark.read.parquet(rows[v]["path"])
        assert rows[v]["rows"] == n == d.count() and [r.w for r in d.select("w").distinct().collect()] == [w]


def test_killed_writer_leaves_no_version(spark, scratch, monkeypatch):
    IO.publish(spark, spark.range(3), "ds", root=scratch)

    class Killed(BaseException):
        pass

    def killed(*_):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", killed)
        m.setattr(commits, "remove", lambda *_: None)  # a killed process tidies nothing
        with pytest.raises(Killed):
            IO.publish(spark, spark.range(100), "ds", root=scratch)
    assert IO.latest_entry(spark, "ds", scratch)["version"] == 1 and IO.read_latest(spark, "ds", scratch).count() == 3
    assert spark.read.parquet(f"{scratch}/ds").count() == 3  # the folder that was left is hidden
    assert IO.publish(spark, spark.range(5), "ds", root=scratch) == 2
    assert IO.read_latest(spark, "ds", scratch).count() == 5
    assert commits.remove_abandoned(spark, f"{scratch}/ds", 3600) == 0
    assert commits.remove_abandoned(spark, f"{scratch}/ds", -1) == 1


def test_failed_write_leaves_nothing(spark, scratch):
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        IO.publish(spark, bad, "ds", root=scratch)
    assert IO.latest_entry(spark, "ds", scratch) is None
    assert commits.remove_abandoned(spark, f"{scratch}/ds", -1) == 0


def test_snapshots_of_the_manifest(spark, scratch, monkeypatch):
    monkeypatch.setattr(IO, "SNAPSHOT_EVERY", 3)
    for i in range(1, 12):
        assert IO.publish(spark, spark.range(i), "ds", root=scratch, fingerprint=f"f{i % 4}") == i
    assert IO._snapshots(spark, scratch, "ds") == [6, 9]
    looked_at = []
    monkeypatch.setattr(commits, "exists", lambda s, p, f=commits.exists: looked_at.append(p) or f(s, p))
    assert IO.latest_entry(spark, "ds", scratch)["rows"] == 11 and len(looked_at) == 3
    for f, v in (("f3", 11), ("f2", 10), ("f1", 9), ("f0", 8), ("none", None)):
        e = IO.latest_entry(spark, "ds", scratch, f)
        assert (e and e["version"]) == v
    rows = IO.manifest(spark, "ds", scratch)
    assert rows.schema == IO.MANIFEST_SCHEMA
    assert sorted((r["version"], r["rows"]) for r in rows.collect()) == [(i, i) for i in range(1, 12)]


def test_empty_and_partitioned_tables(spark, scratch):
    empty = spark.range(0).withColumn("split", F.lit("train"))
    assert IO.publish(spark, empty, "ds", root=scratch, partition_by="split") == 1
    assert IO.latest_entry(spark, "ds", scratch)["rows"] == 0


def test_sketches_of_versions_and_their_union(spark, scratch):
    a = spark.range(0, 20_000).selectExpr("id", "concat('u', id % 700) as u", "cast(null as string) as none")
    b = spark.range(15_000, 50_000).selectExpr("id", "concat('u', id % 900) as u", "cast(null as string) as none")
    assert IO.publish(spark, a, "ds", root=scratch, sketch=["id", "u", "none"]) == 1
    assert IO.publish(spark, b, "ds", root=scratch, sketch=["id", "u", "none"]) == 2
    for versions, exact in (([1], (20_000, 700)), ([2], (35_000, 900)), (None, (50_000, 900)), ([2, 1], (50_000, 900))):
        got = {r["column"]: r.estimate for r in IO.distinct_values(spark, "ds", versions, scratch).collect()}
        for c, n in zip(("id", "u"), exact):
            assert abs(got[c] - n) <= 4 * IO.SKETCH_ERROR * n
        assert got["none"] == 0
    # rows are not read: the data may even be gone
    commits.remove(spark, spark.read.parquet(f"{scratch}/ds/version=1").inputFiles()[0])
    assert IO.distinct_values(spark, "ds", [1], scratch).count() == 3
    IO.publish(spark, a, "ds", root=scratch, sketch=["id"])
    assert [r["column"] for r in IO.distinct_values(spark, "ds", None, scratch).collect()] == ["id"]
    assert IO.distinct_values(spark, "none", None, scratch).count() == 0


def test_moves_through_the_file_system_do_not_overwrite(spark, scratch):
    """The way used on HDFS, on a local folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    first, second = (commits.stage(spark, f"{scratch}/d") for _ in range(2))
    for s in (first, second):
        commits.write_text(spark, f"{s}/a", s)
    target = path(f"file:{scratch.removeprefix('file:')}/d/version=1")
    assert commits._move_hadoop(spark, path(f"file:{first.removeprefix('file:')}"), target)
    assert not commits._move_hadoop(spark, path(f"file:{second.removeprefix('file:')}"), target)
    assert commits.read_text(spark, f"{scratch}/d/version=1/a") == first
    assert commits.exists(spark, second)


def test_other_file_systems_say_so(spark, monkeypatch):
    class At:
        def __init__(self, *a):
            self.a = a

        def getParent(self):
            return self

        def getName(self):
            return "version=1"

        def toUri(self):
            return self

        def getScheme(self):
            return "s3a"

    class Fs:
        def resolvePath(self, p):
            return p

    class Session:
        class _jvm:
            class org:
                class apache:
                    class hadoop:
                        class fs:
                            Path = At
    monkeypatch.setattr(commits, "file_system", lambda *_: (At(), Fs()))
    with pytest.raises(commits.CommitError, match="s3a"):
        commits.commit(Session(), "s3a://b/staged", "s3a://b/version=1")
