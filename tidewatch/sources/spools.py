"""Spool files as a data source of Spark's Python API: whole files, checked where they are read.

`spark.read.format("spool").load(path)` and `spark.readStream.format("spool").load(path)` give one row per
file: path, length, modified, reason, content and first. A good file over `wholeBytes` comes as several rows, each a
snapshot of some of its events, of which `first` is the position of the first one; a bad one of more than
MAX_SPOOL_BYTES stays where it is, and its row has no content. A file whose text is not that of its checksum is marked
and ends up in quarantine, as does one over `maxBytes`, if that option is given; without it a spool of any size is read.
Paths are folders or patterns on any file system pyarrow knows by its URI.
"""

from __future__ import annotations

import fnmatch
import hashlib
import json
import re
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidewatch import fixed
from tidewatch.sources import pieces

SCHEMA = "path STRING, length BIGINT, modified BIGINT, reason STRING, content STRING, first INT"
_BATCH = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified", pa.int64()), ("reason", pa.string()),
                    ("content", pa.string()), ("first", pa.int32())])
FORMAT = "spool"
#: Files put into one task: as many as come to this many bytes, at least one. With the option `tasks` a task gets
#: no more than its share of all bytes, but for small files.
TASK_BYTES = 128 * 1024 * 1024
LEAST_TASK_BYTES = 256 * 1024
#: Files up to this size are one row; rows go to Spark when they come to so many bytes or rows.
WHOLE_BYTES = 16 * 1024 * 1024
BATCH_BYTES, BATCH_ROWS = 4 * 1024 * 1024, 1000
_WILD = re.compile(r"[*?\[]")


class SpoolFiles(InputPartition):
    """Some files, for one task."""

    def __init__(self, files: list[tuple[int, str, int]]):
        super().__init__(files)
        self.files = files


def _opened(path: str):
    """(file system, path within it, what stands before that in the URI)."""
    from pyarrow import fs

    path = re.sub(r"^file:/(?!/)", "file:///", path)
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", path):
        return fs.LocalFileSystem(), path, ""
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: len(path) - len(inner)]


def _listed(path: str) -> list[tuple[int, str, int]]:
    """(modified in microseconds, path, length) of the files of a folder or pattern, in order."""
    from pyarrow import fs

    wild = _WILD.search(path)
    base = path[: path.rindex("/", 0, wild.start())] if wild else path.rstrip("/")
    system, root, before = _opened(base)
    pattern = root + path[len(base):] if wild else None
    found = []
    for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        hidden = info.base_name.startswith(("_", "."))
        if info.is_file and not hidden and (pattern is None or fnmatch.fnmatchcase(info.path, pattern)):
            found.append(((info.mtime_ns or 0) // 1000, before + info.path, info.size))
    return sorted(found)


def _dealt(files: list[tuple[int, str, int]], wanted: int = 1) -> list[SpoolFiles]:
    """Files in tasks of about TASK_BYTES, or less where that makes about as many tasks as wanted."""
    share = sum(file[2] for file in files) // wanted
    most = min(TASK_BYTES, max(LEAST_TASK_BYTES, share))
    tasks: list[list] = []
    room = 0
    for file in files:
        if not tasks or file[2] > room:
            tasks.append([])
            room = most
        tasks[-1].append(file)
        room -= file[2]
    return [SpoolFiles(own) for own in tasks]


def _raw(path: str) -> bytes:
    system, name, _ = _opened(path)
    with system.open_input_stream(name) as stream:
        return stream.read()


def _blocks(path: str) -> Iterator[str]:
    system, name, _ = _opened(path)
    with system.open_input_stream(name) as stream:
        yield from pieces.blocks_of(stream)


def _checked(path: str) -> tuple[str | None, str]:
    """(reason, content); the reason is NULL where the checksum is that of the data."""
    text = _raw(path).decode("utf-8", "replace")
    try:
        entry = json.loads(text)
        data, digest = entry["data"], entry["sha256"]
        known = isinstance(data, str) and isinstance(digest, str)
    except (ValueError, KeyError, TypeError):
        known = False
    if not known:
        return "unreadable", text
    same = hashlib.sha256(data.encode("utf-8", "surrogatepass")).hexdigest() == digest
    return (None if same else "checksum"), text


def _read(path: str, length: int, most: int | None, whole: int) -> Iterator[tuple[str | None, str | None, int]]:
    """(reason, content, first) of a file, or of each of its pieces."""
    if most is not None and length > most:
        yield "too_large", None, 0
    elif length <= whole:
        yield *_checked(path), 0
    else:
        verdict = pieces.judged(_blocks(path))
        if verdict.reason is None:
            for first, content in pieces.pieces(lambda: _blocks(path), verdict):
                yield None, content, first
        else:
            kept = length <= fixed.MAX_SPOOL_BYTES
            yield verdict.reason, _raw(path).decode("utf-8", "replace") if kept else None, 0


class _Reading:
    """What batch and stream share: the tasks' work."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.most = int(options["maxBytes"]) if "maxBytes" in options else None
        self.whole = int(options.get("wholeBytes", WHOLE_BYTES))
        self.tasks = int(options.get("tasks", 1))

    def read(self, partition: SpoolFiles) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind.type) for column, kind in zip(zip(*rows, strict=True), _BATCH, strict=True)], schema=_BATCH)

        for modified, path, length in partition.files:
            for reason, content, first in _read(path, length, self.most, self.whole):
                rows.append((path, length, modified, reason, content, first))
                held += len(content or "")
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


class SpoolReader(_Reading, DataSourceReader):
    def partitions(self) -> list[SpoolFiles]:
        return _dealt(_listed(self.path), self.tasks)


class SpoolStreamReader(_Reading, DataSourceStreamReader):
    """Files in the order of (modified, path); the offset is the last one read.

    A file counts once it has been left alone for `settleSeconds`, so that none with the same time can
    still appear before the offset. A file that is written again is read again.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.settle = float(options.get("settleSeconds", 1))

    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def latestOffset(self) -> dict:
        before = (time.time() - self.settle) * 1_000_000
        files = [file for file in _listed(self.path) if file[0] <= before]
        return {"modified": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[SpoolFiles]:
        first, last = ((offset["modified"], offset["path"]) for offset in (start, end))
        return _dealt([file for file in _listed(self.path) if first < file[:2] <= last], self.tasks)

    def commit(self, end: dict) -> None:
        pass


class SpoolSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SpoolReader:
        return SpoolReader(self.options)

    def streamReader(self, schema) -> SpoolStreamReader:
        return SpoolStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session; safe to call repeatedly."""
    spark.dataSource.register(SpoolSource)
