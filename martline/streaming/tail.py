"""Tailing of growing log files: a streaming source whose offsets are bytes per file.

An offset is the state of the folder: of each file the place after its last whole line, and checksums of its beginning.
It depends on the folder alone, so the positions live in the query's checkpoint and nowhere else. What a batch reads
follows from its two offsets:

* a file that has grown is read from where the batch before ended;
* a half-written last line waits until its line end is there;
* a file that was renamed (rotation) is known by its beginning and read on under its new name, while the file that now
  has its name is read from the start;
* a file that became shorter or begins otherwise (truncation) is read from the start; a copy made before carries on.

Long stretches are cut into splits, so a backlog is read by many tasks. A task checks the beginning of the file before it
reads; if the file was renamed meanwhile it looks for it in the folder, and fails if its content is gone.

Two files whose first ``HEAD`` bytes are equal are told apart by name only. Bytes a file gets after it was renamed and
its name lost from the pattern, and files deleted before a batch saw them, are not read.
"""

from __future__ import annotations

import fnmatch
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes whose checksums tell files apart, and the shortest beginning that does.
HEAD, LEAST_HEAD = 1024, 16
#: Bytes of one split, and bytes read at a time.
SPLIT_BYTES, BLOCK = 64 << 20, 4 << 20
SCHEMA = "value string, file string, position long"


@dataclass(frozen=True)
class Stretch(InputPartition):
    """Lines of ``name`` that begin at ``low`` or later and before ``high``; ``first`` is where a line surely begins."""

    name: str
    head: str
    first: int
    low: int
    high: int


def _heads(data: bytes) -> str:
    """Checksums of the first 16, 32, ... bytes."""
    sizes = []
    n = LEAST_HEAD
    while n <= min(HEAD, len(data)):
        sizes.append(n)
        n *= 2
    return ",".join(str(crc32(data[:n])) for n in sizes)


def _same(a: str, b: str) -> bool:
    """Whether two beginnings agree as far as both are known; unknown ones agree with none."""
    x, y = a.split(","), b.split(",")
    n = min(len(x), len(y))
    return bool(a and b) and x[n - 1] == y[n - 1]


def _last_line_end(file: pa.NativeFile, size: int) -> int:
    """Place after the last line end among the first ``size`` bytes."""
    high = size
    while high:
        low = max(0, high - (1 << 16))
        file.seek(low)
        at = file.read(high - low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        high = low
    return 0


class Tail(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.fs, self.folder = fs.FileSystem.from_uri(options["path"])
        self.pattern = options.get("pattern", "*")
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.seen: dict[str, tuple[int, int, dict]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}}

    def initialOffset(self) -> dict:
        return {}

    def _listed(self) -> Iterator[fs.FileInfo]:
        for info in self.fs.get_file_info(fs.FileSelector(self.folder, allow_not_found=True)):
            if info.type == fs.FileType.File and fnmatch.fnmatch(info.base_name, self.pattern):
                yield info

    def latestOffset(self) -> dict:
        now: dict[str, tuple[int, int, dict]] = {}
        for info in self._listed():
            held = self.seen.get(info.base_name)
            if held is None or held[:2] != (info.size, info.mtime_ns):
                try:
                    with self.fs.open_input_file(info.path) as file:
                        end = _last_line_end(file, info.size)
                        file.seek(0)
                        held = (info.size, info.mtime_ns, {"end": end, "head": _heads(file.read(min(HEAD, end)))})
                except FileNotFoundError:  # renamed since the listing: the next one has it
                    continue
            now[info.base_name] = held
        self.seen = now
        return {name: state for name, (_, _, state) in sorted(now.items()) if state["end"]}

    def partitions(self, start: dict, end: dict) -> Sequence[Stretch]:
        out = []
        for name, state in end.items():
            first = self._from(name, state, start, end)
            for low in range(first, state["end"], self.split):
                out.append(Stretch(name, state["head"], first, low, min(state["end"], low + self.split)))
        return out

    @staticmethod
    def _goes_on(before: dict | None, state: dict | None) -> bool:
        """Whether a file's state can come from an earlier one by writing at its end."""
        if before is None or state is None or before["end"] > state["end"]:
            return False
        return _same(before["head"], state["head"]) if before["head"] else True

    def _from(self, name: str, state: dict, start: dict, end: dict) -> int:
        """Bytes of a file that earlier batches have read, under this name or another."""
        if self._goes_on(start.get(name), state):
            return start[name]["end"]
        moved = (
            before["end"] for other, before in start.items()
            if before["head"] and self._goes_on(before, state) and not self._goes_on(before, end.get(other))
        )
        return max(moved, default=0)

    def _opened(self, part: Stretch) -> pa.NativeFile:
        """The file that the split was planned for, whatever its name is now."""

        def fits(path: str) -> bool:
            try:
                with self.fs.open_input_file(path) as file:
                    return file.size() >= part.high and (not part.head or _heads(file.read(HEAD))[: len(part.head)] == part.head)
            except FileNotFoundError:
                return False

        path = f"{self.folder}/{part.name}"
        paths = [path, *(i.path for i in self.fs.get_file_info(fs.FileSelector(self.folder)) if i.type == fs.FileType.File and i.path != path)]
        for path in paths if part.head else paths[:1]:
            if fits(path):
                return self.fs.open_input_file(path)
        raise FileNotFoundError(f"{self.folder}/{part.name} lost bytes {part.low}-{part.high} before they were read")

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        with self._opened(partition) as file:
            at = partition.low
            if at > partition.first:  # the line that runs into this split belongs to the one before
                file.seek(at - 1)
                at += len(_until_line_end(file)) - 1
            while at < partition.high:
                file.seek(at)
                data = file.read(min(BLOCK, partition.high - at))
                if not data.endswith(b"\n"):
                    data += _until_line_end(file)
                lines = data[:-1].split(b"\n")
                places, place = [], at
                for line in lines:
                    places.append(place)
                    place += len(line) + 1
                texts = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), pa.array([partition.name] * len(lines), pa.string()), pa.array(places, pa.int64())],
                    ["value", "file", "position"],
                )
                at += len(data)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def _until_line_end(file: pa.NativeFile) -> bytes:
    """Bytes from here to the next line end."""
    parts = []
    while True:
        data = file.read(1 << 16)
        at = data.find(b"\n")
        if at >= 0 or not data:
            parts.append(data[: at + 1] if at >= 0 else data)
            return b"".join(parts)
        parts.append(data)


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> Tail:
        return Tail(dict(self.options))


# Tasks get these classes with the plan and need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tail_growing_files(spark: SparkSession, path: str, pattern: str = "*", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines (``value, file, position``) of the files in a folder that match ``pattern``, as they grow, each line once.

    Every file must keep a name that matches while it may still hold unread lines, also when it is rotated.
    """
    spark.dataSource.register(TailSource)
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    return spark.readStream.format("tail").options(path=uri, pattern=pattern, splitBytes=split_bytes).load()
