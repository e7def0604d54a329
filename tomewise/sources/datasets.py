"""Sources and sinks: CSV and Parquet scans, split datasets, versioned
datasets with a manifest, metric logs, stage skipping (IO1-IO10).

A versioned dataset is a Parquet directory ``<root>/<name>/version=<n>`` with
its manifest row beside the data.  A version is written under a name of its own
and takes the next free number by one atomic move (``commits``), so its rows,
its number and its manifest row appear together, and no two writers share any
of them.  Numbers have no gaps; every ``SNAPSHOT_EVERY`` versions the manifest
rows so far are gathered in one snapshot table, and resolving ``latest`` probes
the few numbers after it.  Roots live in a shared folder (the cluster's
checkpoint folder by default), never on one machine's disk.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomewise.session import checkpoint_dir
from tomewise.sources import commits, quoted_csv

REVIEW_CSV_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("book_id", T.LongType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("review_text", T.StringType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("schema", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("created", T.TimestampType()),
])

METRIC_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("logged", T.TimestampType()),
])


# The strings that a pandas CSV read takes as missing by default.
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
              "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


# IO1, IO2 -------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             na_values: bool = True) -> DataFrame:
    """IO1: header, quoted multi-line text, empty and ``NA_STRINGS`` to null.

    Quoted multi-line records are read splittably (``quoted_csv``), so one large
    file keeps many tasks busy.  Without a schema the types are inferred first,
    by Spark's own reader, which reads each file in one task.
    """
    if schema is None:
        schema = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                  .option("inferSchema", True).csv(path).schema)
    df = quoted_csv.read(spark, path, schema)
    if na_values:  # a string column keeps what the parser left; other types have null for them already
        df = df.select([F.when(~F.col(f.name).isin(NA_STRINGS), F.col(f.name)).alias(f.name)
                        if isinstance(f.dataType, T.StringType) else F.col(f.name)
                        for f in df.schema.fields])
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO2: header CSV, quoted so multi-line text survives the round trip, with
    its white space."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


# IO3, IO4 -------------------------------------------------------------------

def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO3: one directory per split (``split=train`` ...)."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """IO4: a split by partition pruning; only its directory is listed."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


# IO5, IO6, IO9 -------------------------------------------------------------

STAGE_ROOT_CONF = "tomewise.stage.root"


def default_root(spark: SparkSession) -> str:
    """Where stages and published datasets live: ``tomewise.stage.root`` if
    set, else ``<checkpoint folder>/datasets``."""
    root = spark.conf.get(STAGE_ROOT_CONF, None)
    return root.rstrip("/") if root else f"{checkpoint_dir(spark)}/datasets"


# A snapshot gathers the manifest rows of all versions every so many versions.
SNAPSHOT_EVERY = 16
_ROW = "_row.json"


def _row_of(spark: SparkSession, root: str, name: str, version: int) -> Row:
    d = json.loads(commits.read_text(spark, f"{root}/{name}/version={version}/{_ROW}"))
    d["created"] = _dt.datetime.fromisoformat(d["created"])
    return Row(**d)


def _snapshots(spark: SparkSession, root: str, name: str) -> list[int]:
    at, fs = commits.file_system(spark, f"{root}/{name}/_snapshots")
    if not fs.exists(at):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit())


def _read_snapshot(spark: SparkSession, root: str, name: str, upto: int) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/{name}/_snapshots/{upto}")


def _versions_after(spark: SparkSession, root: str, name: str, known: int) -> int:
    """The newest version; every number up to it is taken."""
    while commits.exists(spark, f"{root}/{name}/version={known + 1}"):
        known += 1
    return known


def _rows(spark: SparkSession, rows: list[Row]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in MANIFEST_SCHEMA.names) for r in rows], MANIFEST_SCHEMA)


def manifest(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """The manifest rows of all versions of ``name``."""
    root = root or default_root(spark)
    taken = _snapshots(spark, root, name)
    upto = taken[-1] if taken else 0
    last = _versions_after(spark, root, name, upto)
    tail = _rows(spark, [_row_of(spark, root, name, v) for v in range(upto + 1, last + 1)])
    return _read_snapshot(spark, root, name, upto).unionByName(tail) if upto else tail


def latest_entry(spark: SparkSession, name: str, root: str | None = None,
                 fingerprint: str | None = None):
    """Manifest row of the newest version of ``name`` (optionally of one input
    fingerprint), or None.  The few versions after the last snapshot are looked
    at one by one, the snapshot by Spark; one row reaches the driver."""
    root = root or default_root(spark)
    taken = _snapshots(spark, root, name)
    upto = taken[-1] if taken else 0
    last = _versions_after(spark, root, name, upto)
    if fingerprint is None:
        return _row_of(spark, root, name, last) if last else None
    for version in range(last, upto, -1):
        if (row := _row_of(spark, root, name, version)).fingerprint == fingerprint:
            return row
    if not upto:
        return None
    own = _read_snapshot(spark, root, name, upto).where(F.col("fingerprint") == fingerprint)
    return own.agg(F.max_by(F.struct("*"), F.col("version")).alias("e")).head()["e"]


def _take_snapshot(spark: SparkSession, root: str, name: str, upto: int) -> None:
    """All rows up to a version as one table; the one before stays for those
    who are reading it, older ones go."""
    target = f"{root}/{name}/_snapshots/{upto}"
    staged = commits.stage(spark, f"{root}/{name}/_snapshots")
    manifest(spark, name, root).where(F.col("version") <= upto).coalesce(1).write.parquet(staged)
    if not commits.commit(spark, staged, target):
        commits.remove(spark, staged)
    for old in _snapshots(spark, root, name)[:-2]:
        commits.remove(spark, f"{root}/{name}/_snapshots/{old}")


def publish(spark: SparkSession, df: DataFrame, name: str, type_: str = "dataset",
            root: str | None = None, fingerprint: str = "", partition_by: str | None = None,
            sketch: list[str] | tuple = ()) -> int:
    """IO5: write the next version of ``name`` with its manifest row, and with
    a sketch of the distinct values of each column in ``sketch``.

    The data goes to a folder of its own; the version is the first free number,
    taken by moving that folder there.  A writer that loses a number to another
    tries the next one; one that dies before the move leaves no version.
    """
    root = root or default_root(spark)
    staged = commits.stage(spark, f"{root}/{name}")
    try:
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(staged)
        written = spark.read.schema(df.schema).parquet(staged)
        row = {"name": name, "type": type_, "fingerprint": fingerprint, "rows": written.count(),
               "schema": written.schema.json(),
               "created": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()}
        if sketch:
            commits.write_text(spark, f"{staged}/{_SKETCHES}", json.dumps(_sketches(written, list(sketch))))
        last = latest_entry(spark, name, root)
        version = 0 if last is None else last["version"]
        while True:
            version += 1
            path = f"{root}/{name}/version={version}"
            commits.write_text(spark, f"{staged}/{_ROW}", json.dumps(row | {"version": version, "path": path}))
            if commits.commit(spark, staged, path):
                break
    except BaseException:
        commits.remove(spark, staged)
        raise
    if version % SNAPSHOT_EVERY == 0:
        _take_snapshot(spark, root, name, version)
    return version


# AG3 by sketches: beside a version's data lies one HyperLogLog sketch per column,
# of 2**SKETCH_BITS registers; the estimate's relative standard error is
# at most 1.04 / sqrt(2**SKETCH_BITS), for one version and for any union.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
_SKETCHES = "_sketches.json"


def _sketches(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """A sketch per column in one aggregate, as text; null is no value."""
    row = df.agg(*[F.base64(F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS)).alias(f"c{i}")
                   for i, c in enumerate(cols)]).head()
    return dict(zip(cols, row))


def distinct_values(spark: SparkSession, name: str, versions: list[int] | None = None,
                    root: str | None = None) -> DataFrame:
    """AG3, approximate: ``column, estimate`` of the distinct values in the union
    of some versions of ``name`` (default: all) from their sketches alone; no
    row of the data is read.  Columns that a version has no sketch of are left
    out, as their union is unknown."""
    root = root or default_root(spark)
    if versions is None:
        taken = _snapshots(spark, root, name)
        versions = list(range(1, _versions_after(spark, root, name, taken[-1] if taken else 0) + 1))
    files = [f"{root}/{name}/version={v}/{_SKETCHES}" for v in versions]
    found = [json.loads(commits.read_text(spark, f)) for f in files if commits.exists(spark, f)]
    rows = [(c, s) for d in found for c, s in d.items()]
    merged = spark.createDataFrame(rows, "column string, sketch string").groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_estimate(F.hll_union_agg(F.unbase64("sketch"))).alias("estimate"))
    return merged.where(F.col("n") == len(versions)).select("column", "estimate")


def read_latest(spark: SparkSession, name: str, root: str | None = None,
                fingerprint: str | None = None) -> DataFrame:
    """IO6: resolve ``name:latest`` through the manifest and scan it."""
    e = latest_entry(spark, name, root, fingerprint)
    if e is None:
        raise FileNotFoundError(f"no published version of {name!r}")
    return spark.read.parquet(e["path"])


def materialize(spark: SparkSession, name: str, fingerprint: str, build,
                root: str | None = None, partition_by: str | None = None) -> DataFrame:
    """IO9: skip a stage whose output for this input fingerprint exists.

    ``build()`` returns the stage's DataFrame; it is written once as a new
    version and every later call reads the written table, which also cuts
    the lineage of the stages after it.
    """
    root = root or default_root(spark)
    memo = (root, name, fingerprint)
    path = _RESOLVED.get(memo)
    if path is None or not commits.exists(spark, path):
        e = latest_entry(spark, name, root, fingerprint)
        if e is None:
            v = publish(spark, build(), name, "stage", root, fingerprint, partition_by)
            path = f"{root}/{name}/version={v}"
        else:
            path = e["path"]
        _RESOLVED[memo] = path
    return spark.read.parquet(path)


# (root, name, fingerprint) -> written path.  A stage written for a
# fingerprint never changes, so a resolved path is reused without scanning
# the manifest again (only its existence is checked).
_RESOLVED: dict = {}


@lru_cache(maxsize=1)
def code_fingerprint() -> str:
    """Hash of this package's source as it was first asked for: a stage written
    by other code is never reused."""
    import hashlib
    import pathlib
    h = hashlib.md5()
    pkg = pathlib.Path(__file__).resolve().parent.parent
    for f in sorted(pkg.rglob("*.py")):
        h.update(f.read_bytes())
    return h.hexdigest()[:12]


def input_fingerprint(*paths: str) -> str:
    """Path, size and modification time of every file of each input (file or
    dataset folder, any file system that Spark reads), hashed by Spark, plus
    the code fingerprint.  Files rewritten in place or in nested folders show;
    paths that do not exist keep their name."""
    spark = SparkSession.getActiveSession()
    parts = [code_fingerprint()]
    for p in paths:
        if spark is None or not commits.exists(spark, p):
            parts.append(p)
            continue
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
                      .select("path", "length", "modificationTime"))  # contents are not read
        n, size, mark = files.agg(F.count(F.lit(1)), F.sum("length"),
                                  F.expr("bit_xor(xxhash64(path, length, modificationTime))")).head()
        parts.append(f"{p}:{n}:{size}:{mark}")
    return "|".join(parts)


# IO7, IO8, IO10 ------------------------------------------------------------

def publish_table(df: DataFrame, path: str) -> None:
    """IO7: a result table for later inspection."""
    df.write.mode("overwrite").parquet(path)


def log_metrics(spark: SparkSession, run_id: str, metrics: dict, root: str | None = None) -> None:
    """IO8: append ``(run_id, key, value)`` rows to the metric log."""
    root = root or default_root(spark)
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, str(k), float(v), now) for k, v in metrics.items()]
    spark.createDataFrame(rows, METRIC_SCHEMA).coalesce(1).write.parquet(f"{root}/_metrics/{uuid.uuid4().hex}")


def log_metric_table(df: DataFrame, run_id: str, keys: list[str], root: str | None = None) -> None:
    """IO8 for a metric table of any size, in Spark: every number outside the
    ``keys`` columns becomes a row whose key is the keys' values and the
    column's name, joined by ``_``."""
    numbers = [f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, T.NumericType)]
    entries = F.array(*[F.struct(F.concat_ws("_", *[F.col(k).cast("string") for k in keys], F.lit(c)).alias("key"),
                                 F.col(c).cast("double").alias("value")) for c in numbers])
    rows = df.select(F.explode(entries).alias("e")).select(
        F.lit(run_id).alias("run_id"), "e.key", "e.value", F.current_timestamp().alias("logged"))
    rows.write.parquet(f"{root or default_root(df.sparkSession)}/_metrics/{uuid.uuid4().hex}")


def read_metrics(spark: SparkSession, root: str | None = None) -> DataFrame:
    root = root or default_root(spark)
    return spark.read.schema(METRIC_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/_metrics")


def reload_if_empty(df: DataFrame | None, loader) -> DataFrame:
    """IO10: use ``df`` unless it is missing or has no rows."""
    if df is None or df.isEmpty():
        return loader()
    return df
