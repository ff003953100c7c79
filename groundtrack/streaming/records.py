"""Raw records in segment files, as a data source of Spark's Python interface:
what the jobs read from and write to a message broker, without one.

A log is a folder with ``segments`` (files of records) and ``commits`` (one small
manifest a batch that names the segments it added and the offsets they hold).
Only what a manifest names counts, so a failed or repeated write leaves nothing
behind that a reader sees.

* Reading: ``spark.readStream.format("groundtrack_records").load(path)`` gives
  ``value, topic, partition, offset``. Options: ``subscribe`` (one topic) or
  ``subscribePattern`` (whole-name regular expression); ``startingOffsets``
  (``earliest``, ``latest``); ``maxRecordsPerBatch``, which admits at most so
  many records a micro-batch, in the order they were committed and wherever that
  falls inside a file. It needs ``progress``, a folder of this query next to its
  checkpoint, in which the reader notes how far it has planned, so that a
  restart goes on from there. Batch reads give all that is committed.
* Writing: ``df.writeStream.format("groundtrack_records")`` with columns
  ``topic`` and ``value``. Tasks write segments and send a commit message with
  their counts; the driver gives them offsets in one manifest, named by the
  batch. A log has one writing query. Option ``partitions``: partitions of the
  log (tasks are dealt over them).

A path is one that all executors reach: a mounted folder or a URI that Arrow's
file systems know.
"""

from __future__ import annotations

import json
import posixpath
import re
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage

# the source's code goes to the workers with it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "groundtrack_records"
SCHEMA = "value string, topic string, partition int, offset bigint"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RawRecords)


class Log:
    """Manifests and segments below a path."""

    def __init__(self, path: str):
        self._fs, self._root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        self._read: dict[str, list[dict]] = {}

    def path(self, *names: str) -> str:
        return posixpath.join(self._root, *names)

    def names(self, folder: str) -> list[str]:
        found = self._fs.get_file_info(pafs.FileSelector(self.path(folder), allow_not_found=True))
        return sorted(i.base_name for i in found if i.is_file)

    def segments(self) -> list[dict]:
        """All committed segments in commit order: file, partition, base, count."""
        for name in self.names("commits"):
            if name.endswith(".json") and name not in self._read:
                self._read[name] = json.loads(self.text("commits", name))
        return [s for name in sorted(self._read) for s in self._read[name]]

    def heads(self) -> dict[str, int]:
        """Offset behind the last record of each partition."""
        out: dict[str, int] = {}
        for s in self.segments():
            out[str(s["partition"])] = s["base"] + s["count"]
        return out

    def text(self, *names: str) -> str:
        with self._fs.open_input_stream(self.path(*names)) as f:
            return f.read().decode()

    def put(self, text: str, *names: str) -> None:
        """A whole file at once: written aside, then moved."""
        self._fs.create_dir(posixpath.dirname(self.path(*names)), recursive=True)
        aside = self.path(*names[:-1], f".{names[-1]}.{uuid.uuid4().hex}")
        with self._fs.open_output_stream(aside) as f:
            f.write(text.encode())
        self._fs.move(aside, self.path(*names))

    def exists(self, *names: str) -> bool:
        return self._fs.get_file_info(self.path(*names)).type == pafs.FileType.File

    def new_segment(self):
        name = f"{uuid.uuid4().hex}.jsonl"
        self._fs.create_dir(self.path("segments"), recursive=True)
        return name, self._fs.open_output_stream(self.path("segments", name))

    def delete(self, *names: str) -> None:
        if self.exists(*names):
            self._fs.delete_file(self.path(*names))

    def lines(self, name: str) -> Iterator[str]:
        """The lines of a segment, a few megabytes at a time."""
        rest = b""
        with self._fs.open_input_stream(self.path("segments", name)) as f:
            while chunk := f.read(4 << 20):
                *whole, rest = (rest + chunk).split(b"\n")
                yield from (x.decode() for x in whole)


@dataclass
class Span(InputPartition):
    """Records ``lo`` .. ``hi`` - 1 (offsets) of one segment."""

    file: str
    partition: int
    base: int
    lo: int
    hi: int


def spans(segments: list[dict], start: dict, end: dict | None) -> list[Span]:
    out = []
    for s in segments:
        p = str(s["partition"])
        lo, hi = max(s["base"], start.get(p, 0)), s["base"] + s["count"]
        hi = hi if end is None else min(hi, end.get(p, 0))
        if lo < hi:
            out.append(Span(s["file"], s["partition"], s["base"], lo, hi))
    return out


class _Reader:
    def __init__(self, options):
        self._options = dict(options)
        self._path = self._options["path"]
        one, pattern = self._options.get("subscribe"), self._options.get("subscribepattern")
        self._topic = re.compile(re.escape(one) if one else pattern) if one or pattern else None

    def read(self, partition: Span) -> Iterator[tuple]:
        for i, line in enumerate(Log(self._path).lines(partition.file), partition.base):
            if i >= partition.hi:
                return
            if i >= partition.lo:
                topic, value = json.loads(line)
                if self._topic is None or (topic is not None and self._topic.fullmatch(topic)):
                    yield value, topic, partition.partition, i


class RecordReader(_Reader, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return spans(Log(self._path).segments(), {}, None) or [Span("", 0, 0, 0, 0)]

    def read(self, partition: Span) -> Iterator[tuple]:
        return super().read(partition) if partition.file else iter(())


class RecordStreamReader(_Reader, DataSourceStreamReader):
    """Offsets are ``{partition: next offset}``."""

    def __init__(self, options):
        super().__init__(options)
        self._log = Log(self._path)
        self._most = int(self._options.get("maxrecordsperbatch", 0))
        if self._most and "progress" not in self._options:
            raise ValueError("maxRecordsPerBatch needs the option progress")
        self._at: dict | None = None

    def initialOffset(self) -> dict:
        return self._log.heads() if self._options.get("startingoffsets", "earliest") == "latest" else {}

    def _planned(self) -> dict:
        """Where the next batch begins: planned last by this reader, or by the one before a restart."""
        if self._at is None:
            notes = Log(self._options["progress"])
            self._at = json.loads(notes.text("planned.json")) if notes.exists("planned.json") else self.initialOffset()
        return self._at

    def latestOffset(self) -> dict:
        heads = self._log.heads()
        if not self._most:
            return heads
        start, left = self._planned(), self._most
        end = dict(start)
        for s in spans(self._log.segments(), start, heads):
            take = min(left, s.hi - s.lo)
            end[str(s.partition)] = s.lo + take
            left -= take
            if not left:
                break
        return end

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self._most:
            Log(self._options["progress"]).put(json.dumps(end), "planned.json")
            self._at = end
        return spans(self._log.segments(), start, end)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    file: str
    partition: int
    count: int


class RecordStreamWriter(DataSourceStreamWriter):
    def __init__(self, options):
        self._path, self._partitions = options["path"], int(options.get("partitions", 1))

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        log, file, out, n = Log(self._path), "", None, 0
        held: list[str] = []
        for row in iterator:
            if out is None:
                file, out = log.new_segment()
            held.append(json.dumps([row["topic"], row["value"]]))
            n += 1
            if len(held) >= 4096:
                out.write(("\n".join(held) + "\n").encode())
                held = []
        if out is not None:
            if held:
                out.write(("\n".join(held) + "\n").encode())
            out.close()
        return Written(file, TaskContext.get().partitionId() % self._partitions, n)

    @staticmethod
    def _manifest(batchId: int) -> str:
        return f"{int(batchId):020d}.json"

    def commit(self, messages, batchId: int) -> None:
        log = Log(self._path)
        if log.exists("commits", self._manifest(batchId)):          # a batch that was committed before a restart
            self.abort(messages, batchId)
            return
        at, added = log.heads(), []
        for m in messages:
            if m is not None and m.count:
                base = at.get(str(m.partition), 0)
                added.append({"file": m.file, "partition": m.partition, "base": base, "count": m.count})
                at[str(m.partition)] = base + m.count
        log.put(json.dumps(added), "commits", self._manifest(batchId))

    def abort(self, messages, batchId: int) -> None:
        for m in messages:
            if m is not None and m.file:
                Log(self._path).delete("segments", m.file)


class RawRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RecordReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RecordStreamReader(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return RecordStreamWriter(self.options)


def read_log(spark: SparkSession, path: str, **options):
    """The records of a log as a stream."""
    register(spark)
    r = spark.readStream.format(NAME)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)
