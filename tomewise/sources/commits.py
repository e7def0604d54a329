"""Written folders that appear at once: optimistic commits without a lock.

A writer fills a folder of its own, whose name is unique and hidden from
readers (``_staged/<id>``), and then moves it to its final name in one step
that fails if the name is taken.  Data, and whatever lies beside the data in
the folder, become visible together or not at all: a writer that dies before
the step leaves only a hidden folder, and of two writers that want one name
exactly one gets it.

The step needs a file system that moves a folder without overwriting: a local
one (``rename(2)`` fails on a folder with files in it) or HDFS (the name node
decides).  Any other, object stores included, copies file by file, and
committing there is an error that says so.
"""

from __future__ import annotations

import errno
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

STAGED = "_staged"


class CommitError(RuntimeError):
    pass


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = file_system(spark, path)
    return fs.exists(at)


def stage(spark: SparkSession, parent: str) -> str:
    """The path of a new hidden folder below ``parent``."""
    path = f"{parent.rstrip('/')}/{STAGED}/{uuid.uuid4().hex}"
    at, fs = file_system(spark, path)
    fs.mkdirs(at.getParent())
    return path


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file beside the data of a staged folder."""
    at, fs = file_system(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def _move_local(source: str, target: str) -> bool:
    try:
        os.rename(source, target)
        return True
    except OSError as e:
        if e.errno in (errno.ENOTEMPTY, errno.EEXIST, errno.ENOTDIR):
            return False
        raise


def _move_hadoop(spark: SparkSession, source, target) -> bool:
    """A rename that the file system refuses if ``target`` exists."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(source, target, no_options)
        return True
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise


def commit(spark: SparkSession, staged: str, target: str) -> bool:
    """Move the folder ``staged`` to ``target`` in one step; False, with
    nothing changed, if ``target`` has been taken."""
    source, fs = file_system(spark, staged)
    source = fs.resolvePath(source)  # a mount point is the file system behind it
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    parent = fs.resolvePath(goal.getParent())
    goal = spark._jvm.org.apache.hadoop.fs.Path(parent, goal.getName())
    kind = goal.toUri().getScheme() or "file"
    if kind == "file":
        return _move_local(source.toUri().getPath(), goal.toUri().getPath())
    if kind == "hdfs":
        return _move_hadoop(spark, source, goal)
    raise CommitError(f"{kind}: this file system does not move a folder in one step without overwriting, so a commit "
                      "could mix two writers; publish to HDFS or to a local folder")


def remove(spark: SparkSession, path: str) -> None:
    at, fs = file_system(spark, path)
    fs.delete(at, True)


def remove_abandoned(spark: SparkSession, parent: str, older_than_seconds: float) -> int:
    """Delete hidden folders that no writer has touched for so long; how many."""
    import time
    at, fs = file_system(spark, f"{parent.rstrip('/')}/{STAGED}")
    if not fs.exists(at):
        return 0
    bar, gone = (time.time() - older_than_seconds) * 1000, 0
    for status in fs.listStatus(at):
        if status.getModificationTime() < bar:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone
