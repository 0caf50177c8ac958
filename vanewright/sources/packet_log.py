"""A packet log in a shared folder, as a Spark data source.

``segments/`` holds parquet files of (key, value) packets; ``commits/`` holds one small JSON
manifest per committed batch, numbered without gaps, which lists the segments that the batch added.  Only what a
manifest lists is part of the log, so tasks that are repeated, speculated or lost leave
nothing behind that a reader sees.

Writing has two phases: tasks write segments of at most ``segment_rows`` packets, then the driver adds the
manifest in one step that fails if the number is taken.  A streaming query names itself with ``writer``; a batch that it
repeats after a failure is found in the log and left out.  One query of a name writes at a time.

Reading: the offset of a stream is the number of commits read, and every segment is one
partition.  ``commits_per_batch`` bounds a micro-batch of a query that has a name of its own (``consumer``).
A restarted query goes on at the offset of its own checkpoint, so it loses and repeats nothing.

``send_packets`` deals packets by key, so those of a key and commit are in one segment, in any order.
The folder has to be one that the driver and all executors share.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

FORMAT = "packet_log"
SCHEMA = "key string, value string"
SEGMENT_ROWS = 250_000


class Log:
    """Files of one log, on any file system that the root's address names."""

    def __init__(self, root: str) -> None:
        self.root = root
        if "://" in root or root.startswith("file:"):
            self.fs, self.path = fs.FileSystem.from_uri(root)
        else:
            self.fs, self.path = fs.LocalFileSystem(), os.path.abspath(root)

    def _names(self) -> list[int]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.path}/commits", allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))

    def latest(self) -> int:
        """Number of commits."""
        return max(self._names(), default=0)

    def manifest(self, number: int) -> dict:
        with self.fs.open_input_stream(f"{self.path}/commits/{number:020}.json") as f:
            return json.loads(f.read())

    def segments(self, start: int, end: int) -> list[str]:
        """Of the commits after ``start`` up to ``end``."""
        return [s for n in range(start + 1, end + 1) for s in self.manifest(n)["segments"]]

    def add_segment(self, table: pa.Table) -> str:
        name = f"{uuid.uuid4().hex}.parquet"
        self.fs.create_dir(f"{self.path}/segments", recursive=True)
        pq.write_table(table, f"{self.path}/segments/{name}", filesystem=self.fs, compression="zstd")
        return name

    def read_segment(self, name: str) -> Iterator[pa.RecordBatch]:
        yield from pq.ParquetFile(f"{self.path}/segments/{name}", filesystem=self.fs).iter_batches()

    def drop_segments(self, names: Sequence[str]) -> None:
        for name in names:
            self.fs.delete_file(f"{self.path}/segments/{name}")

    def committed(self, writer: str, batch: int) -> bool:
        """Whether the batch of a writer is in the log already; its batches come in order."""
        for number in reversed(self._names()):
            held = self.manifest(number)
            if held["writer"] == writer:
                return held["batch"] >= batch
        return False

    def commit(self, segments: Sequence[str], rows: int, writer: str = "", batch: int = -1) -> None:
        body = {"segments": list(segments), "rows": rows, "writer": writer, "batch": batch}
        self.fs.create_dir(f"{self.path}/commits", recursive=True)
        draft = f"{self.path}/commits/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(body).encode())
        while True:
            target = f"{self.path}/commits/{self.latest() + 1:020}.json"
            if not isinstance(self.fs, fs.LocalFileSystem):
                if self.fs.get_file_info(target).type == fs.FileType.NotFound:
                    self.fs.move(draft, target)
                    return
                continue
            try:
                os.link(draft, target)  # fails if another commit took the number
            except FileExistsError:
                continue
            self.fs.delete_file(draft)
            return

    def position(self, consumer: str) -> int:
        """Commits that a bounded reader has reported as done."""
        path = f"{self.path}/consumers/{consumer}.json"
        if self.fs.get_file_info(path).type == fs.FileType.NotFound:
            return 0
        with self.fs.open_input_stream(path) as f:
            return json.loads(f.read())["commits"]

    def set_position(self, consumer: str, commits: int) -> None:
        self.fs.create_dir(f"{self.path}/consumers", recursive=True)
        draft = f"{self.path}/consumers/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps({"commits": commits}).encode())
        self.fs.move(draft, f"{self.path}/consumers/{consumer}.json")

    def unused(self) -> list[str]:
        """Segments that no commit lists, left by lost tasks.  Ask only while nobody writes."""
        used = set(self.segments(0, self.latest()))
        found = self.fs.get_file_info(fs.FileSelector(f"{self.path}/segments", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name not in used)


@dataclass
class Segment(InputPartition):
    name: str


@dataclass
class Written(WriterCommitMessage):
    segments: list[str]
    rows: int


class _Reader(DataSourceReader):
    def __init__(self, root: str) -> None:
        self.root = root

    def partitions(self) -> Sequence[InputPartition]:
        log = Log(self.root)
        return [Segment(s) for s in log.segments(0, log.latest())]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # a log without segments
            yield from Log(self.root).read_segment(partition.name)


class _StreamReader(DataSourceStreamReader):
    """``given`` is the offset that Spark was told last; it only grows.  Spark does not say where a query that
    starts again stands, so a bounded one keeps its position under its name: at most one batch behind."""

    def __init__(self, root: str, most: int, consumer: str) -> None:
        if most and not consumer:
            raise ValueError("commits_per_batch needs a name for the reading query: option consumer")
        self.root, self.most, self.consumer, self.given = root, most, consumer, None

    def initialOffset(self) -> dict:
        return {"commits": 0}

    def latestOffset(self) -> dict:
        log = Log(self.root)
        latest = log.latest()
        if self.most:
            start = log.position(self.consumer) if self.given is None else self.given
            latest = max(start, min(latest, start + self.most))
        self.given = latest
        return {"commits": latest}

    def commit(self, end: dict) -> None:
        if self.most:
            Log(self.root).set_position(self.consumer, end["commits"])

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if end["commits"] < start["commits"]:
            raise ValueError(f"consumer {self.consumer} stands before the query's checkpoint; give the query a name of its own")
        return [Segment(s) for s in Log(self.root).segments(start["commits"], end["commits"])]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        yield from Log(self.root).read_segment(partition.name)


def _write(root: str, most: int, batches: Iterator[pa.RecordBatch]) -> Written:
    log, held, rows, total, names = Log(root), [], 0, 0, []
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, most - rows)
            held.append(part)
            at, rows, total = at + part.num_rows, rows + part.num_rows, total + part.num_rows
            if rows == most:
                names.append(log.add_segment(pa.Table.from_batches(held)))
                held, rows = [], 0
    if rows:
        names.append(log.add_segment(pa.Table.from_batches(held)))
    return Written(names, total)


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str, rows: int) -> None:
        self.root, self.rows = root, rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.root, self.rows, iterator)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        Log(self.root).commit([s for m in done for s in m.segments], sum(m.rows for m in done))

    def abort(self, messages: list[Written | None]) -> None:
        Log(self.root).drop_segments([s for m in messages if m is not None for s in m.segments])


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, root: str, rows: int, writer: str) -> None:
        self.root, self.rows, self.writer = root, rows, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _write(self.root, self.rows, iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        done, log = [m for m in messages if m is not None], Log(self.root)
        segments = [s for m in done for s in m.segments]
        if log.committed(self.writer, batchId):
            log.drop_segments(segments)
        else:
            log.commit(segments, sum(m.rows for m in done), self.writer, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        Log(self.root).drop_segments([s for m in messages if m is not None for s in m.segments])


class PacketLog(DataSource):
    """Options: ``path``; ``commits_per_batch`` and ``consumer`` of a reading stream; ``segment_rows``; ``writer`` of a writing stream."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _rows(self) -> int:
        return int(self.options.get("segment_rows", SEGMENT_ROWS))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options["path"], int(self.options.get("commits_per_batch", 0)), self.options.get("consumer", ""))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a packet log is appended to only")
        return _Writer(self.options["path"], self._rows())

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        if "writer" not in self.options:
            raise ValueError("a stream that writes to a packet log needs a name: option writer")
        return _StreamWriter(self.options["path"], self._rows(), self.options["writer"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PacketLog)
