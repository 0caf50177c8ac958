"""Files of any size by ranges, as a Spark data source: first bytes, or a digest by chunks.

A task opens a file and reads only what it needs, ``head_bytes`` of it or one chunk of ``chunk_bytes`` after
another, so no file has to fit a row or a task's memory.  Small files share a task, up to
``task_bytes`` of what is read; a file's digest is one task's work, as SHA-256 takes its bytes in order.

The file system has to be one that ``pyarrow.fs`` opens (local, HDFS, S3, GCS); ``opens`` tells.
"""

from __future__ import annotations

import fnmatch
import hashlib
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "file_ranges"
SCHEMA = "path string, length long, modificationTime timestamp, head binary, sha256 string"
ARROW = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")),
                   ("head", pa.binary()), ("sha256", pa.string())])
CHUNK_BYTES = 8 << 20
TASK_BYTES = 1 << 30
#: What opening a file costs, as bytes read.
OPEN_BYTES = 4 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path on it, and what stands before it in an address."""
    if "://" in path or path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path)
        return system, inner, "file:" if isinstance(system, fs.LocalFileSystem) else path[:path.index(inner)]
    return fs.LocalFileSystem(), os.path.abspath(path), "file:"


def opens(path: str) -> bool:
    try:
        system, inner, _ = _opened(path)
        return system.get_file_info(inner).type != fs.FileType.NotFound
    except (ValueError, OSError, pa.ArrowInvalid):
        return False


@dataclass
class Files(InputPartition):
    names: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.head = int(options.get("head_bytes", 0))
        self.digest = options.get("digest", "true") == "true"
        self.chunk, self.task = int(options.get("chunk_bytes", CHUNK_BYTES)), int(options.get("task_bytes", TASK_BYTES))

    def partitions(self) -> Sequence[InputPartition]:
        system, inner, _ = _opened(self.path)
        top = system.get_file_info(inner)
        found = [top] if top.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
        hidden = lambda p: any(part.startswith((".", "_")) for part in p[len(inner):].split("/") if part)
        files = sorted((f for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, self.glob)
                        and (f is top or not hidden(f.path))), key=lambda f: f.path)
        parts, held, size = [], [], 0
        for f in files:
            cost = OPEN_BYTES + (f.size if self.digest else self.head)
            if held and size + cost > self.task:
                parts.append(Files(held))
                held, size = [], 0
            held.append(f.path)
            size += cost
        return [*parts, *([Files(held)] if held else [])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing was found
            return
        system, _, before = _opened(self.path)
        for name in partition.names:
            info = system.get_file_info(name)
            head, digest = b"", hashlib.sha256()
            with system.open_input_stream(name) as f:
                if self.head:
                    head = f.read(self.head)
                    digest.update(head)
                while self.digest and (part := f.read(self.chunk)):
                    digest.update(part)
            row = [before + name, info.size, info.mtime, head if self.head else None, digest.hexdigest() if self.digest else None]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, ARROW)], schema=ARROW)


class FileRanges(DataSource):
    """Options: ``path``, ``glob`` of names, ``head_bytes``, ``digest`` (true), ``chunk_bytes``, ``task_bytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FileRanges)
