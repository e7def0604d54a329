"""WARC archives with a two-level capture index.

Writing: payloads are digested by SQL functions, equal ones find their smallest
id by an aggregate with map-side minimum, and each task writes its rows as
gzip records into archives of bounded size; a payload that an earlier id holds
becomes a revisit record.  An archive is written under a name of its own for
each attempt and moved into place when complete, and its place is reported by
rows that are written once with ``checkpoint()``, so a lost executor leaves at
most a file that nothing refers to.

Index: one line per capture under the URL's reversed host (com,example)/path,
range-sorted over the cluster; each task writes its range as gzip blocks of
``block_lines`` lines into one file, and beside it a sparse directory with the
first key, the offset and the length of every block.  A table with one row per
range names the files.

Look-up: requests are range-sorted, too; a request finds its range by binary
search in the ranges' first keys, its block by binary search in the range's
directory, its lines by binary search in the block, and reads the record by its
byte range.  A task reads each block once.

Files go through Arrow's file systems, so the root may be a local, HDFS or
object-store path that all executors share.  Defined results: a null payload
is empty; payloads shorter than ``revisit_bytes`` are never revisits; a null URL is
filed under the empty key; a null id is never the one referred to while another
id has the payload; rows with equal ids are each written; other columns are
not read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import math
import re
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewise.llm.batches import quoted
from tomewise.operators.joins import join_once
from tomewise.session import reliable

REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1_000
GZIP_LEVEL = 4
REQUESTS_PER_TASK = 10_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_END = b"\r\n\r\n"
_NO_PAGE = -(1 << 63)  # stands for a null id in the index
_FOUND = [("key", pa.string()), ("page", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]


def url_key(url: str | None) -> str:
    """The sort key of a URL: host reversed and without ``www.``, port other
    than the scheme's, path and query in lower case, no fragment."""
    try:
        part = urlsplit((url or "").strip())
        host, port = (part.hostname or ""), part.port
    except ValueError:
        return re.sub(r"\s", "%20", url or "").lower()
    if not host:
        return re.sub(r"\s", "%20", url or "").lower()
    host = re.sub(r"^www\d*\.", "", host)
    key = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(part.scheme):
        key += f":{port}"
    path = (part.path or "/") + (f"?{part.query}" if part.query else "")
    return re.sub(r"\s", "%20", f"{key}){path}").lower()


def _record_id(page: int | None) -> str:
    return f"<urn:capture:{'none' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str) -> bytes:
    """One WARC record; a revisit has the HTTP head as its whole block."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page)),
            ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Payload-Length", str(len(payload))),
             ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    block = _HTTP + (payload if refers_to is None else b"")
    head.append(("Content-Length", str(len(block))))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + _END


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(named["Content-Length"])]
    return named, block.partition(b"\r\n\r\n")[2]


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(root)
    return fs, path.rstrip("/")


class _Output:
    """A file that gets its name when it is complete."""

    def __init__(self, fs: pafs.FileSystem, folder: str, stem: str):
        self.fs, self.name = fs, f"{stem}-{uuid.uuid4().hex}"
        self.path, self.size = f"{folder}/{self.name}", 0
        fs.create_dir(folder, recursive=True)
        self.out = fs.open_output_stream(f"{self.path}.part", compression=None)

    def write(self, data: bytes) -> tuple[int, int]:
        at, self.size = self.size, self.size + len(data)
        self.out.write(data)
        return at, len(data)

    def close(self) -> str:
        self.out.close()
        self.fs.move(f"{self.path}.part", self.path)
        return self.name


def write_archives(df: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", revisit_bytes: int = REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row under ``root`` and returns its captures:
    ``page, key, file, at, size``."""
    payload = F.coalesce(F.col(quoted(payload_col)), F.lit("")).cast("binary")
    rows = df.select(F.col(quoted(id_col)).cast("long").alias("page"), F.col(quoted(url_col)).cast("string").alias("url"),
                     payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    large = (rows.where((F.octet_length("payload") >= revisit_bytes) & F.col("page").isNotNull())
                 .select("page", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long").alias("d"), "digest"))
    first = (large.groupBy("d", "digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("d", F.struct("digest", "first").alias("x"))
                  .groupBy("d").agg(F.collect_list("x").alias("xs")))  # more than one only if 60 bits clash
    revisits = (join_once(large, first, "d").select("page", "digest", F.explode("xs").alias("x"))
                .where("digest = x.digest and page > x.first")
                .select(F.col("page").alias("of"), F.col("digest").alias("of_digest"), F.col("x.first").alias("refers_to"))
                .distinct())
    planned = rows.join(revisits, (F.col("page") == F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")

    def run(batches):
        fs, folder = _open(root)
        out = None
        for batch in batches:
            got = {"page": [], "key": [], "file": [], "at": [], "size": []}
            for page, url, data, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and out.size >= archive_bytes:
                    out.close()
                    out = None
                if out is None:
                    out = _Output(fs, f"{folder}/archive", "captures")
                raw = gzip.compress(record(page, url, data, digest, refers_to, date), GZIP_LEVEL, mtime=0)
                at, size = out.write(raw)
                for name, x in zip(got, (page, url_key(url), out.name, at, size)):
                    got[name].append(x)
            yield pa.RecordBatch.from_pydict(got, schema=pa.schema(
                [("page", pa.int64()), ("key", pa.string()), ("file", pa.string()), ("at", pa.int64()),
                 ("size", pa.int64())]))
        if out is not None:
            out.close()

    return reliable(planned.select("page", "url", "payload", "digest", "refers_to")
                           .mapInArrow(run, "page long, key string, file string, at long, size long"))


def write_index(captures: DataFrame, root: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the captures' index under ``root`` and returns its ranges:
    ``first_key, first_page, file, directory, blocks``, one row per file."""
    def run(batches):
        fs, folder = _open(root)
        out, lines, directory = None, [], []

        def flush():
            at, size = out.write(gzip.compress("".join(json.dumps(x) + "\n" for x in lines).encode(), 6, mtime=0))
            directory.append([lines[0][0], lines[0][1], at, size])
            lines.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = _Output(fs, f"{folder}/index", "blocks")
                lines.append(line)
                if len(lines) == block_lines:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        sparse = _Output(fs, f"{folder}/index", "directory")
        sparse.write("".join(json.dumps(x) + "\n" for x in directory).encode())
        yield pa.RecordBatch.from_pylist([{
            "first_key": directory[0][0], "first_page": directory[0][1], "file": out.close(),
            "directory": sparse.close(), "blocks": len(directory)}])

    page = F.coalesce("page", F.lit(_NO_PAGE)).alias("page")
    return reliable(captures.select("key", page, "file", "at", "size").repartitionByRange("key", "page")
                            .sortWithinPartitions("key", "page", "file", "at")
                            .mapInArrow(run, "first_key string, first_page long, file string, directory string, blocks long"))


class _Reader:
    """Reads directories, blocks and records of one root, with open files kept."""

    def __init__(self, root: str, ranges: list[tuple]):
        self.fs, self.folder = _open(root)
        self.ranges = sorted(ranges)  # (first key, first page, file, directory)
        self.starts = [x[:2] for x in self.ranges]
        self.files: dict[str, pa.NativeFile] = {}
        self.directory: tuple = (None, [], [])
        self.block: tuple = (None, [], [])

    def read(self, path: str, at: int, size: int) -> bytes:
        if path not in self.files:
            if len(self.files) >= 64:
                self.files.pop(next(iter(self.files))).close()
            self.files[path] = self.fs.open_input_file(f"{self.folder}/{path}")
        return self.files[path].read_at(size, at)

    def _directory(self, name: str) -> tuple[list, list]:
        if self.directory[0] != name:
            with self.fs.open_input_stream(f"{self.folder}/index/{name}", compression=None) as f:
                blocks = [json.loads(x) for x in f.read().splitlines()]
            self.directory = (name, blocks, [(b[0], b[1]) for b in blocks])
        return self.directory[1:]

    def _lines(self, name: str, at: int, size: int) -> tuple[list, list]:
        if self.block[0] != (name, at):
            raw = gzip.decompress(self.read(f"index/{name}", at, size))
            lines = [json.loads(x) for x in raw.splitlines()]
            self.block = ((name, at), lines, [(x[0], x[1]) for x in lines])
        return self.block[1:]

    def find(self, key: str, page: int | None = None) -> Iterator[tuple]:
        """The captures ``(page, file, at, size)`` of a key, or of one page of it."""
        low = (key, _NO_PAGE if page is None else page)
        high = (key, (1 << 63) - 1 if page is None else page)
        for r in range(max(0, bisect_left(self.starts, low) - 1), bisect_right(self.starts, high)):
            blocks, firsts = self._directory(self.ranges[r][3])
            for b in range(max(0, bisect_left(firsts, low) - 1), bisect_right(firsts, high)):
                lines, keys = self._lines(self.ranges[r][2], *blocks[b][2:])
                for x in lines[bisect_left(keys, low):bisect_right(keys, high)]:
                    yield tuple(x[1:])


def look_up(requests: DataFrame, ranges: DataFrame, root: str, payloads: bool = True,
            requests_per_task: int = REQUESTS_PER_TASK) -> DataFrame:
    """The captures of each different request ``url[, page]``: ``key, page,
    record_type, refers_to, payload_bytes, payload_digest, payload`` as read
    from the archives.  Payloads are checked against their digests; that of a
    revisit is the referred record's, so it is null here, and all are null
    unless ``payloads`` are wanted."""
    # one row per range: their number is that of the index's partitions
    named = [tuple(r) for r in ranges.select("first_key", "first_page", "file", "directory").collect()]
    one = "page" in requests.columns

    def keyed(batches):
        for batch in batches:
            page = batch.column(1) if one else pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string()), page], names=["key", "page"])

    def run(batches):
        reader = _Reader(root, named)
        names = [n for n, _ in _FOUND]
        for batch in batches:
            got = []
            for key, page in zip(*(c.to_pylist() for c in batch.columns)):
                for own, file, at, size in reader.find(key, (_NO_PAGE if page is None else page) if one else None):
                    head, payload = parse(gzip.decompress(reader.read(f"archive/{file}", at, size)))
                    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha256:"), head["WARC-Type"]
                    length = int(head["Payload-Length"])
                    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (length, digest):
                        raise OSError(f"damaged record in {file} at {at}")
                    other = re.fullmatch(r"<urn:capture:(-?\d+)>", head.get("WARC-Refers-To", ""))
                    got.append((key, None if own == _NO_PAGE else own, kind, int(other[1]) if other else None, length,
                                digest, payload if payloads and kind == "response" else None))
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*got) if got else [()] * len(names))),
                                             schema=pa.schema(_FOUND))

    asked = requests.select("url", *["page"] * one).mapInArrow(keyed, "key string, page long").distinct()
    # a request is a few bytes, but costs a read: tasks are sized by requests
    tasks = max(1, math.ceil(requests.count() / requests_per_task))
    return (asked.repartitionByRange(tasks, "key", "page").sortWithinPartitions("key", "page")
                 .mapInArrow(run, "key string, page long, record_type string, refers_to long, payload_bytes long, "
                                  "payload_digest string, payload binary"))
