"""Files of any size on executors: complete listings, hashes, copies, CSV records.

Executors open files through Arrow and read them in blocks, so no file is ever
a value in a row. Two Python data sources plan their partitions themselves:

* ``FileListing``: a partition is a folder. Empty files and names that start
  with ``_`` or ``.`` are listed like any other, as an object store lists them.
* ``CsvRecords``: a partition is a chunk of a file. Whether a byte lies inside
  a quoted field depends on all bytes before it, so a first pass tells for each
  chunk how it maps each state of the CSV grammar at its start to one at its
  end; composed from the front, these maps give every chunk's true state. A chunk
  then gives the records that begin in it, reading on past its end for the last.
"""

from __future__ import annotations

import csv
import datetime as dt
import fnmatch
import hashlib
import io
import itertools
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes that are read or copied at once.
BLOCK = 4 << 20
#: Bytes of a CSV file that one task parses.
CHUNK = 32 << 20
#: Listing: folders wanted as partitions, levels looked at to find them.
FOLDERS, LEVELS = 64, 3
#: Files on their way to their name begin so; listings leave them out.
TEMPORARY = "._unfinished."

#: Hadoop scheme -> the scheme under which Arrow opens the same store.
ARROW_SCHEMES = {
    "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "gs": "gs",
    "s3": "s3", "s3a": "s3", "s3n": "s3", "abfs": "abfs", "abfss": "abfss",
}
_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(.*)", re.S)


def can_open(path: str) -> bool:
    """Whether executors can open files of the path's scheme."""
    m = _SCHEME.match(path)
    return m is None or m[1].lower() in ARROW_SCHEMES


def arrow_uri(path: str) -> str:
    """``path`` as Arrow's file systems name it; an unknown scheme raises."""
    m = _SCHEME.match(path)
    if m is None:
        return path
    scheme, rest = m[1].lower(), m[2]
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"Cannot open files on {scheme}: (known: {sorted(ARROW_SCHEMES)})")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    return f"{ARROW_SCHEMES[scheme]}:{rest}"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system of ``path`` and its name there. Only scheme and host are read
    as a URI: the rest is a name, whatever characters it has."""
    m = re.match(r"([a-z0-9]+://[^/]*)(/.*)?\Z", arrow_uri(path), re.S)
    if m is None:
        return pafs.LocalFileSystem(), arrow_uri(path)
    filesystem, base = pafs.FileSystem.from_uri(m[1] + "/")
    return filesystem, base.rstrip("/") + (m[2] or "/")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and host, by the cluster's default file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


# --- listing ---------------------------------------------------------------------
LISTING_SCHEMA = "path string, modificationTime timestamp, length long"
_LISTED = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())])


@dataclass
class Folder(InputPartition):
    name: str  # below the root, with a slash before it
    recursive: bool


class FileListing(DataSource):
    """Options: path, recursive ("true" or "false"), glob (of file names)."""

    @classmethod
    def name(cls) -> str:
        return "reelhouse_listing"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FileListingReader(self.options["path"], self.options.get("recursive") == "true", self.options.get("glob"))


class FileListingReader(DataSourceReader):
    def __init__(self, path: str, recursive: bool, glob: str | None):
        self.path, self.recursive, self.glob = path.rstrip("/"), recursive, glob

    def partitions(self) -> Sequence[Folder]:
        """Folders of the first level that has enough, or of the last one looked
        at, with all below; and each folder above, alone. A missing path has none."""
        filesystem, root = opened(self.path)
        if filesystem.get_file_info(root).type != pafs.FileType.Directory:
            return []
        if not self.recursive:
            return [Folder("", False)]
        above, level = [], [""]
        for _ in range(LEVELS):
            if len(level) >= FOLDERS:
                break
            above += [Folder(f, False) for f in level]
            found = [filesystem.get_file_info(pafs.FileSelector(root + f, allow_not_found=True)) for f in level]
            level = [f"{f}/{i.base_name}" for f, infos in zip(level, found) for i in infos if i.type == pafs.FileType.Directory]
        return above + [Folder(f, True) for f in level]

    def read(self, partition: Folder | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # given when there are none
            return
        filesystem, root = opened(self.path)
        infos = filesystem.get_file_info(pafs.FileSelector(root + partition.name, allow_not_found=True, recursive=partition.recursive))
        files = [i for i in infos if i.type == pafs.FileType.File and not i.base_name.startswith(TEMPORARY)
                 and (self.glob is None or fnmatch.fnmatchcase(i.base_name, self.glob))]
        for at in range(0, len(files), 10_000):
            some = files[at:at + 10_000]
            columns = [[self.path + i.path[len(root):] for i in some], [i.mtime and i.mtime.astimezone(dt.timezone.utc) for i in some], [i.size for i in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LISTED)], schema=_LISTED)


def listing(spark: SparkSession, path: str, recursive: bool, glob: str | None = None) -> DataFrame:
    """path, modificationTime and length of the files in a folder; none if it is missing."""
    spark.dataSource.register(FileListing)
    options = {"recursive": str(recursive).lower()} | ({"glob": glob} if glob else {})
    return spark.read.format("reelhouse_listing").options(**options).load(qualified(spark, path))


# --- hashes and copies ---------------------------------------------------------------
def _blocks(path: str) -> Iterator[bytes]:
    filesystem, name = opened(path)
    with filesystem.open_input_stream(name) as stream:
        while block := stream.read(BLOCK):
            yield block


def _spread(files: DataFrame, path_col: str) -> DataFrame:
    """One file after another in as many tasks as a shuffle has (a listing may be one task)."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), path_col)


def hashed(files: DataFrame, path_col: str = "path") -> DataFrame:
    """``files`` with size_bytes and sha256 of each file's bytes, read in blocks."""
    schema = ", ".join(f"`{n}` {t}" for n, t in files.dtypes) + ", size_bytes long, sha256 string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for path in batch.column(path_col).to_pylist():
                size, digest = 0, hashlib.sha256()
                for block in _blocks(path):
                    size += len(block)
                    digest.update(block)
                sizes.append(size)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                             [*batch.schema.names, "size_bytes", "sha256"])

    return _spread(files, path_col).mapInArrow(read, schema)


def copied(files: DataFrame, to_dir: str, path_col: str, key_col: str, sha_col: str) -> None:
    """Copy each file's bytes to ``to_dir/<key>``, in blocks.

    A file is written under a temporary name that no listing shows and then moved
    to its key, so no reader sees a part of it; a task that runs again writes the
    same bytes to the same key. Bytes that no longer have the given hash stop the job.
    """
    target_dir = qualified(files.sparkSession, to_dir).rstrip("/")
    opened(target_dir)  # an unknown scheme raises here

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path, key, sha in zip(*(batch.column(c).to_pylist() for c in (path_col, key_col, sha_col))):
                filesystem, target = opened(f"{target_dir}/{key}")
                folder, name = target.rsplit("/", 1)
                filesystem.create_dir(folder, recursive=True)
                temporary, digest = f"{folder}/{TEMPORARY}{attempt}.{name}", hashlib.sha256()
                with filesystem.open_output_stream(temporary) as out:
                    for block in _blocks(path):
                        digest.update(block)
                        out.write(block)
                if digest.hexdigest() != sha:
                    filesystem.delete_file(temporary)
                    raise ValueError(f"{path} changed while it was uploaded")
                filesystem.move(temporary, target)
            yield batch.select([key_col])

    keys = _spread(files.select(path_col, key_col, sha_col), path_col).mapInArrow(copy, f"`{key_col}` string")
    keys.write.format("noop").mode("overwrite").save()


# --- CSV records -----------------------------------------------------------------------
# A place in a CSV file: at the start of a record or of a further field, in a plain
# field, in a quoted one, or behind a quote in a quoted one (the end of it, or the first of
# two). What follows a closing quote up to the delimiter is plain. Outside quotes,
# LF, CR and CRLF end a record.
RECORD, FIELD, PLAIN, QUOTED, CLOSED = range(5)
_INSIDE = rb'(?:[^"]++|"")*+'
_ONE = rb'(?:"' + _INSIDE + rb'"[^,\r\n]*+|(?:[^",\r\n][^,\r\n]*+)?+)'
_FIELDS = re.compile(rb"(?:" + _ONE + rb"[,\r\n])*+")
_RECORD = re.compile(rb"(?:" + _ONE + rb",)*+" + _ONE + rb"[\r\n]")
_PLAIN_REST, _QUOTED_REST = re.compile(rb"[^,\r\n]*+"), re.compile(_INSIDE)


def _resumed(data: bytes, state: int) -> tuple[int, int]:
    """(place behind the field that ``state`` lies in, RECORD or FIELD), or (length, state there)."""
    at = 0
    if state == CLOSED:
        if not data:
            return 0, CLOSED
        at, state = (1, QUOTED) if data[:1] == b'"' else (0, PLAIN)
    if state == QUOTED:
        at = _QUOTED_REST.match(data, at).end()
        if at == len(data):
            return at, QUOTED
        at += 1
        if at == len(data):
            return at, CLOSED
        state = PLAIN
    if state == PLAIN:
        at = _PLAIN_REST.match(data, at).end()
        if at == len(data):
            return at, PLAIN
        return at + 1, FIELD if data[at:at + 1] == b"," else RECORD
    return at, state


def state_after(data: bytes, state: int) -> int:
    """The state behind ``data`` if it begins in ``state``."""
    at, state = _resumed(data, state)
    if at == len(data):
        return state
    end = _FIELDS.match(data, at).end()
    if end == len(data):
        return FIELD if data[-1:] == b"," else RECORD
    return _resumed(data[end + 1:], QUOTED)[1] if data[end:end + 1] == b'"' else PLAIN


def first_record(data: bytes, state: int) -> int | None:
    """Where the first record begins in ``data``, if any does."""
    at, state = _resumed(data, state)
    if state == FIELD:
        m = _RECORD.match(data, at)
        return m.end() if m else None
    return at if state == RECORD else None


def records(data: bytes, state: int, more: Callable[[], bytes]) -> Iterator[bytes]:
    """The records that begin in ``data``, without line ends and blank lines.
    ``more`` gives bytes behind ``data``, none at the end of the file."""
    at, own = first_record(data, state), len(data)
    if at is None:
        return
    while at < own:
        m = _RECORD.match(data, at)
        while m is None:
            block = more()
            if not block:
                yield data[at:]
                return
            data, own, at = data[at:] + block, own - at, 0
            m = _RECORD.match(data, at)
        if m.end() - at > 1:
            yield data[at:m.end() - 1]
        at = m.end()


@dataclass
class Chunk(InputPartition):
    file: int
    number: int
    path: str
    start: int
    end: int
    state: int


class CsvRecords(DataSource):
    """Options: files (JSON: path, first byte, size, states of its chunks or none), chunk (bytes)."""

    @classmethod
    def name(cls) -> str:
        return "reelhouse_csv"

    def reader(self, schema) -> DataSourceReader:
        return CsvRecordsReader(json.loads(self.options["files"]), int(self.options["chunk"]), schema.fieldNames())


class CsvRecordsReader(DataSourceReader):
    def __init__(self, files: list, chunk: int, columns: list[str]):
        self.files, self.chunk, self.columns = files, chunk, columns

    def partitions(self) -> Sequence[Chunk]:
        out = []
        for i, (path, first, size, states) in enumerate(self.files):
            for k, start in enumerate(range(first, size, self.chunk)):
                out.append(Chunk(i, k, path, start, min(start + self.chunk, size), int(states[k]) if states else RECORD))
        return out

    def read(self, partition: Chunk | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        filesystem, name = opened(partition.path)
        with filesystem.open_input_file(name) as f:
            f.seek(partition.start)
            data = f.read(partition.end - partition.start)
            if self.columns != ["record"]:
                ends = "".join(str(state_after(data, s)) for s in range(5))
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (partition.file, partition.number, ends)], self.columns)
                return
            some, size, blocks = [], 0, itertools.count()
            # Ever larger blocks: a record is looked at again with each of them.
            for r in records(data, partition.state, lambda: f.read(BLOCK << next(blocks))):
                some.append(r)
                size += len(r)
                if size >= BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["record"])
                    some, size = [], 0
            if some:
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["record"])


@dataclass
class Head:
    """A CSV file: its header's fields, where its rows begin, and its size."""
    path: str
    fields: list[str]
    first: int
    size: int


def read_head(path: str) -> Head:
    """Reads no more of the file than its header, in blocks."""
    filesystem, name = opened(path)
    data, whole = b"", False
    with filesystem.open_input_file(name) as f:
        size = f.size()
        while not whole:
            block = f.read(1 << 16)
            data, whole = data + block, not block
            at = 3 if data.startswith(b"\xef\xbb\xbf") else 0
            while (m := _RECORD.match(data, at)) and m.end() - at == 1:  # a blank line
                at = m.end()
            if m:
                break
    record, first = (data[at:m.end() - 1], m.end()) if m else (data[at:], size)
    rows = list(csv.reader(io.StringIO(record.decode("utf-8", "replace"), newline="")))
    return Head(path, rows[0] if rows else [], first, size)


def csv_records(spark: SparkSession, heads: Sequence[Head], chunk: int | None = None) -> DataFrame:
    """``record``: the records of CSV files as bytes, headers left out, a task for each chunk.

    Files of more than one chunk are read twice: the driver gets five digits for
    each of their chunks, which say how the chunk maps the states.
    """
    chunk = chunk or CHUNK
    spark.dataSource.register(CsvRecords)

    def source(files: list, schema: str) -> DataFrame:
        return spark.read.format("reelhouse_csv").schema(schema).options(files=json.dumps(files), chunk=str(chunk)).load()

    states = [""] * len(heads)
    large = [i for i, h in enumerate(heads) if h.size - h.first > chunk]
    if large:
        files = [[heads[i].path, heads[i].first, heads[i].size, ""] for i in large]
        maps: list[dict[int, str]] = [{} for _ in large]
        for r in source(files, "file long, number long, ends string").collect():
            maps[r["file"]][r["number"]] = r["ends"]
        for i, ends in zip(large, maps):
            state, found = RECORD, []
            for k in range(len(ends)):
                found.append(str(state))
                state = int(ends[k][state])
            states[i] = "".join(found)
    return source([[h.path, h.first, h.size, s] for h, s in zip(heads, states)], "record binary")
