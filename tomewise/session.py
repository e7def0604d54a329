"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (coalesces small shuffle
# partitions, splits skewed join partitions, turns joins into broadcasts from
# runtime sizes), UTC timestamps and Arrow for the few pandas hand-offs.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tomewise", extra: dict | None = None) -> SparkSession:
    """Return the active session or build a local one with ``BASE_CONF``.

    On a cluster the submitter owns master, memory and partition counts;
    locally (tests, bench) we size shuffles to the core count.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; a session on one machine
    (``local`` master) gets a folder of its own if the setting is absent, any
    other master without it is an error, as executors share no local folder.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tomewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def reliable(df):
    """``df`` written with a reliable ``checkpoint()`` into the shared folder
    (lineage cut; survives the loss of the executors that computed it)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_dir(spark: SparkSession, what: str) -> str:
    """The path of a new folder below the shared one."""
    return f"{checkpoint_dir(spark)}/{what}/{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system the shared one is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
