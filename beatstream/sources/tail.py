"""Following growing log files: a streaming source over appended lines.

``read_play_lines_stream`` of ``sources.files`` takes whole new files.  A log collector
follows files that grow and rotate: here an offset says how far each file has been read, and a
micro-batch is the byte ranges between two offsets.

- A file is known by a hash of its first line, so a renamed file goes on where it was left and
  a new file of the old name starts at its beginning.  A file that is shorter than what was
  read of it was cut off and filled anew: it starts at its beginning too.
- A range ends at a line end; a half-written last line waits until it is complete.
- Ranges are cut into pieces of ``partitionBytes``; a line belongs to the piece in which it
  starts, so a large append is read by many tasks.
- An offset holds everything a batch needs.  A batch that is repeated after a failure reads
  the same ranges, also if a file was renamed meanwhile (it is found by its first line).  If
  its lines are gone, the query fails, or goes on without them (``failOnDataLoss`` false).

The start position is used only when a query has no checkpoint: ``earliest``, ``latest``
(only what is appended from now on) or a time: the first line of each file whose time field is
not before it.  For the latter each file's lines must ascend by time; lines without a readable
time are passed over in the search.

Two files that start with the same line (a header) are told apart by their names alone.
An offset names every file of the folder, so finished files should be moved away in time.
Files whose names start with a dot or underscore are left out.  Empty lines are rows; bytes
that aren't UTF-8 are replaced.  The folder must be reachable from the driver and the
executors: a shared mount, or any file system that Arrow reads by its URI.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# the reader runs in Python workers: they need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "growing_log"
SCHEMA = "value string, file string, position long"
HEAD = 1 << 16         # bytes of a first line that count
CHUNK = 1 << 20
MISSES = 20            # listings in a row that may miss a file before its place in it is forgotten
TIME = re.compile(rb"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d")


@dataclass
class LogPiece(InputPartition):
    """Lines of ``name`` (known by ``head``) that start at ``start`` or later and before ``end``; the range ends at ``stop``."""

    name: str
    head: str
    start: int
    end: int
    stop: int
    first: bool  # ``start`` is the start of a line


class LogFolder:
    """The log files of a folder."""

    def __init__(self, path: str, pattern: str = "*"):
        self.fs, self.base = pafs.FileSystem.from_uri(path)
        if self.fs.get_file_info(self.base).type == pafs.FileType.File:
            self.base, _, pattern = self.base.rpartition("/")
            pattern += "*"  # with the names it is rotated to
        self.pattern = pattern
        self.seen: dict[str, tuple[tuple, list]] = {}
        self.known: dict[str, tuple[list, int]] = {}

    def names(self) -> list[pafs.FileInfo]:
        infos = self.fs.get_file_info(pafs.FileSelector(self.base, allow_not_found=True))
        return [i for i in infos if i.type == pafs.FileType.File and i.base_name[0] not in "._"
                and fnmatch.fnmatch(i.base_name, self.pattern)]

    def snapshot(self) -> dict[str, list]:
        """{name: [hash of the first line, end of the last complete line]} of files with a complete line."""
        infos = {i.base_name: i for i in self.names()}
        seen = {n: self.seen[n] for n, i in infos.items() if n in self.seen and self.seen[n][0] == (i.size, i.mtime_ns)}
        changed = [i for n, i in infos.items() if n not in seen]  # only these are opened, several at a time
        with ThreadPoolExecutor(16) as pool:
            for info, known in zip(changed, pool.map(self._measure, changed), strict=True):
                seen[info.base_name] = ((info.size, info.mtime_ns), known)
        self.seen = seen
        found = {n: known for n, (_, known) in sorted(seen.items()) if known}
        # a file that a rename hides from this listing isn't forgotten at once: it would be read again
        heads = {head for head, _ in found.values()}
        absent = {}
        for name, (entry, times) in self.known.items():
            if entry[0] not in heads and times < MISSES:
                absent[name if name not in found else f"{name.split('~')[0]}~{entry[0]}"] = (entry, times + 1)
        self.known = {n: (e, 0) for n, e in found.items()} | absent
        return found | {n: e for n, (e, _) in absent.items()}

    def _measure(self, info: pafs.FileInfo) -> list | None:
        try:
            f = self.open(info.base_name)
        except FileNotFoundError:  # renamed since the listing: the next snapshot has it
            return None
        with f:
            size = min(info.size, f.size())
            head = self.head(f)
            end = size
            while head and end > 0:
                begin = max(0, end - HEAD)
                f.seek(begin)
                at = f.read(end - begin).rfind(b"\n")
                if at >= 0:
                    return [head, begin + at + 1]
                end = begin
        return None

    def open(self, name: str) -> pa.NativeFile:
        return self.fs.open_input_file(f"{self.base}/{name}")

    @staticmethod
    def head(f: pa.NativeFile) -> str | None:
        """Hash of a file's first line; None while that is incomplete."""
        f.seek(0)
        raw = f.read(HEAD)
        end = raw.find(b"\n")
        if end < 0 and len(raw) < HEAD:
            return None
        return hashlib.sha1(raw if end < 0 else raw[:end + 1]).hexdigest()[:16]

    def find(self, name: str, head: str, stop: int) -> str | None:
        """The current name of a file that holds the bytes up to ``stop``."""
        for each in (name, *sorted(i.base_name for i in self.names() if i.base_name != name)):
            try:
                with self.open(each) as f:
                    if f.size() >= stop and self.head(f) == head:
                        return each
            except FileNotFoundError:
                continue
        return None

    def since(self, name: str, end: int, moment: bytes, field: int) -> int:
        """Position of the first line whose time is ``moment`` or later, by bisection (lines ascend by time)."""
        with self.open(name) as f:

            def timed(at: int) -> tuple[int, bytes | None]:
                """The first line with a time that starts at ``at`` or later: its start and time."""
                if at:  # to the next line start
                    f.seek(at - 1)
                    at += len(_line(f)) - 1
                while at < end:
                    f.seek(at)
                    line = _line(f)
                    parts = line.split(b",")
                    stamp = TIME.match(parts[field].strip().strip(b'"')) if len(parts) > field else None
                    if stamp:
                        return at, stamp[0]
                    at += len(line)
                return end, None

            low, high = 0, end  # every timed line starting before ``low`` is earlier; the one from ``high`` on isn't
            while low < high:
                middle = (low + high) // 2
                _, stamp = timed(middle)
                if stamp is not None and stamp < moment:
                    low = middle + 1
                else:
                    high = middle
            return timed(low)[0]


def _line(f: pa.NativeFile) -> bytes:
    """The bytes from the file's position to the end of the line."""
    parts = []
    while raw := f.read(HEAD):
        at = raw.find(b"\n")
        parts.append(raw if at < 0 else raw[:at + 1])
        if at >= 0:
            break
    return b"".join(parts)


def ranges(start: dict[str, list], end: dict[str, list]) -> list[tuple[str, str, int, int]]:
    """(name, first line's hash, begin, stop) of what lies between two snapshots."""
    same = {n: start[n] for n, (head, stop) in end.items() if n in start and start[n][0] == head and start[n][1] <= stop}
    # a file that left its name: known by its first line, the furthest one if several have it
    left = {}
    for name, (head, at) in start.items():
        if name not in same and at > left.get(head, 0):
            left[head] = at
    out = []
    for name, (head, stop) in sorted(end.items()):
        begin = same[name][1] if name in same else 0
        if name not in same and left.get(head, stop + 1) <= stop:
            begin = left.pop(head)
        if begin < stop:
            out.append((name, head, begin, stop))
    return out


class GrowingLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.pattern = options.get("pathGlobFilter", "*")
        self.starting = options.get("startingPosition", "earliest")
        self.field = int(options.get("timestampField", "3"))
        self.piece = int(options.get("partitionBytes", str(64 << 20)))
        self.strict = str(options.get("failOnDataLoss", "true")).lower() != "false"
        self.folder: LogFolder | None = None

    def _folder(self) -> LogFolder:
        if self.folder is None:
            self.folder = LogFolder(self.path, self.pattern)
        return self.folder

    def __getstate__(self):
        return self.__dict__ | {"folder": None}

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            return {"files": {}}
        now = self._folder().snapshot()
        if self.starting != "latest":
            moment = self.starting.encode()
            if not TIME.fullmatch(moment):
                raise ValueError("startingPosition must be earliest, latest or yyyy-MM-dd HH:mm:ss")
            now = {n: [head, self._folder().since(n, end, moment, self.field)] for n, (head, end) in now.items()}
        return {"files": now}

    def latestOffset(self) -> dict:
        return {"files": self._folder().snapshot()}

    def partitions(self, start: dict, end: dict) -> list[LogPiece]:
        out = []
        for name, head, begin, stop in ranges(start["files"], end["files"]):
            for at in range(begin, stop, self.piece):
                out.append(LogPiece(name, head, at, min(at + self.piece, stop), stop, at == begin))
        return out or [LogPiece("", "", 0, 0, 0, True)]

    def read(self, partition: LogPiece) -> Iterator[pa.RecordBatch]:
        p = partition
        if p.start == p.end:
            return
        name = self._folder().find(p.name, p.head, p.stop)
        if name is None:
            if self.strict:
                raise RuntimeError(f"{p.name} no longer holds bytes {p.start} to {p.stop}")
            return
        with self._folder().open(name) as f:
            at = p.start
            if not p.first:  # the line that reaches into this piece belongs to the one before
                f.seek(at - 1)
                at += len(_line(f)) - 1
            while at < p.end:
                f.seek(at)
                raw = f.read(min(CHUNK, p.end - at))
                cut = raw.rfind(b"\n") + 1
                if at + len(raw) >= p.end or not cut:  # the last line may end behind the piece
                    f.seek(at + cut)
                    raw = raw[:cut] + (_line(f) if at + cut < p.end else b"")
                else:
                    raw = raw[:cut]
                lines = raw.split(b"\n")[:-1] if raw.endswith(b"\n") else raw.split(b"\n")
                starts = [at]
                for line in lines[:-1]:
                    starts.append(starts[-1] + len(line) + 1)
                at += len(raw)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines], pa.string()),
                     pa.array([p.name] * len(lines), pa.string()), pa.array(starts, pa.int64())],
                    ["value", "file", "position"])

    def commit(self, end: dict) -> None:
        pass


class GrowingLog(DataSource):
    """``spark.readStream.format("growing_log")`` after ``register``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingLogReader:
        return GrowingLogReader(self.options)


def follow_lines(spark: SparkSession, path: str, starting: str = "earliest", **options: str) -> DataFrame:
    """Lines appended to the files of a folder (or to one file and what it is rotated to), as a stream.

    Columns: ``value``, ``file`` and ``position`` (the line's first byte).  ``starting`` is
    ``earliest``, ``latest`` or a time ``yyyy-MM-dd HH:mm:ss``; a query with a checkpoint
    goes on where it was and ignores it.  Other options: ``pathGlobFilter``,
    ``timestampField`` (number of the comma-separated field with the time, from 0),
    ``partitionBytes`` and ``failOnDataLoss``.
    """
    spark.dataSource.register(GrowingLog)
    reader = spark.readStream.format(FORMAT).option("startingPosition", starting)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(path)
