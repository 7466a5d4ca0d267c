"""The files of one folder as a data source of Spark, for batch and stream.

Every file counts, empty and hidden ones too, which Spark's own file sources pass over. The names of a folder are dealt to
ranges by hash; a task goes through the names and asks the store about its own range only, so neither
listing nor reading is done by the driver. The offset of the stream is a point in time: a batch holds the files that
arrived or changed between two points.
"""

from __future__ import annotations

import json
import os
import time
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

LISTING = "path string, size_bytes bigint, modified_at timestamp"
NAME = "pagemill_folder"
# A batch of rows leaves a task when it holds so many files or bytes.
BATCH_FILES = 1000
BATCH_BYTES = 16 << 20
# Files that arrive while a point in time is taken get this long to be seen.
SETTLE_SECONDS = 0.05
# Schemes that tasks can open themselves; what Hadoop calls s3a is s3 for others.
REMOTE = {"s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs"}


@dataclass(frozen=True)
class Entry:
    name: str
    size: int
    changed: int  # nanoseconds


class Folder:
    """A folder in a store that tasks can open: a local or mounted one, or one that Arrow has a file system for."""

    def __init__(self, uri: str):
        parts = urlsplit(uri)
        self.uri = uri.rstrip("/")
        self.local = parts.scheme in ("", "file")
        if self.local:
            self.path = unquote(parts.path) if parts.scheme else os.path.abspath(uri)
            self.uri = "file:" + self.path.rstrip("/")
        elif parts.scheme in REMOTE:
            from pyarrow import fs

            self.system, self.path = fs.FileSystem.from_uri(REMOTE[parts.scheme] + uri[len(parts.scheme) :])
        else:
            raise ValueError(f"tasks cannot open {parts.scheme}: folders")

    @staticmethod
    def can_open(uri: str) -> bool:
        return urlsplit(uri).scheme in ("", "file", *REMOTE)

    def entries(self, part: int = 0, parts: int = 1) -> Iterator[Entry]:
        """Files directly inside the folder whose names fall to a range; none if it is missing."""
        if self.local:
            try:
                found = os.scandir(self.path)
            except (FileNotFoundError, NotADirectoryError):
                return
            with found:
                for entry in found:
                    if zlib.crc32(os.fsencode(entry.name)) % parts != part:
                        continue
                    try:
                        if entry.is_file():
                            seen = entry.stat()
                            # A file that was moved here is as new as one that was written here.
                            yield Entry(entry.name, seen.st_size, max(seen.st_mtime_ns, seen.st_ctime_ns))
                    except FileNotFoundError:  # gone meanwhile
                        continue
            return
        from pyarrow import fs

        # A listing of such a store holds size and time already.
        for info in self.system.get_file_info(fs.FileSelector(self.path, allow_not_found=True)):
            if info.type == fs.FileType.File and zlib.crc32(info.base_name.encode()) % parts == part:
                yield Entry(info.base_name, info.size, info.mtime_ns or 0)

    def read(self, name: str) -> bytes | None:
        """The bytes of a file; None if it cannot be read, so that one file does not end a run."""
        try:
            if self.local:
                with open(os.path.join(self.path, name), "rb") as file:
                    return file.read()
            with self.system.open_input_stream(f"{self.path}/{name}") as stream:
                return stream.read()
        except OSError:
            return None

    def write(self, name: str, content: bytes) -> None:
        """Put a whole file in place; a task that runs again writes the same."""
        if not self.local:
            with self.system.open_output_stream(f"{self.path}/{name}") as stream:
                stream.write(content)
            return
        os.makedirs(self.path, exist_ok=True)
        part = os.path.join(self.path, f".{name}.{os.getpid()}.{time.monotonic_ns()}.part")
        with open(part, "wb") as file:
            file.write(content)
        os.replace(part, os.path.join(self.path, name))


@dataclass
class Range(InputPartition):
    """A range of names, and the points in time between which its files changed."""

    part: int
    parts: int
    after: int = -1
    until: int | None = None


class _Files:
    """What both readers share."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.suffixes = tuple(s.lower() for s in json.loads(options.get("suffixes", '[""]')))
        self.ranges = int(options.get("ranges", "8"))
        self.content = options.get("content", "false").lower() == "true"
        self.settle = float(options.get("settleseconds", SETTLE_SECONDS))

    def _ranges(self, after: int = -1, until: int | None = None) -> list[Range]:
        return [Range(part, self.ranges, after, until) for part in range(self.ranges)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        folder, rows, held = Folder(self.folder), [], 0
        for entry in folder.entries(partition.part, partition.parts):
            late = partition.until is not None and entry.changed > partition.until
            if late or entry.changed <= partition.after or not entry.name.lower().endswith(self.suffixes):
                continue
            row = [f"{folder.uri}/{entry.name}", entry.size, datetime.fromtimestamp(entry.changed / 1e9, timezone.utc)]
            if self.content:
                row.append(folder.read(entry.name))
                held += len(row[-1] or b"")
            rows.append(row)
            if len(rows) == BATCH_FILES or held >= BATCH_BYTES:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[list]) -> pa.RecordBatch:
        fields = [("path", pa.string()), ("size_bytes", pa.int64()), ("modified_at", pa.timestamp("us", "UTC"))]
        fields += [("content", pa.binary())] if self.content else []
        columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


class FolderReader(_Files, DataSourceReader):
    def partitions(self) -> Sequence[Range]:
        return self._ranges()


class FolderStreamReader(_Files, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"until": -1}

    def latestOffset(self) -> dict:
        now = time.time_ns()
        time.sleep(self.settle)
        return {"until": now}

    def partitions(self, start: dict, end: dict) -> Sequence[Range]:
        return self._ranges(start["until"], end["until"])

    def commit(self, end: dict) -> None:
        """Nothing is kept: the checkpoint of the query holds the offset."""


class FolderSource(DataSource):
    """Options: ``path``; ``suffixes`` as a JSON list; ``ranges``, the number of tasks; ``content``; ``settleSeconds``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return LISTING + (", content binary" if self.options.get("content", "false").lower() == "true" else "")

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options)

    def streamReader(self, schema) -> FolderStreamReader:
        return FolderStreamReader(self.options)


def folder_options(
    spark: SparkSession, folder: str, suffixes: Sequence[str], content: bool = False
) -> dict[str, str]:
    """Options of the source for a folder; the source is known to the session from then on."""
    spark.dataSource.register(FolderSource)
    return {
        "path": folder, "suffixes": json.dumps(list(suffixes)), "content": str(content).lower(),
        "ranges": str(2 * spark.sparkContext.defaultParallelism),
    }
