"""Logs that still grow, as a stream: ``format("appended")``.

A stream's position is one byte position per file, kept in the query's checkpoint; nothing runs beside
the query. A batch takes what was appended to each file since the last one, up to the last line end:
a line without its end yet waits. Ranges are cut into splits that tasks read in parallel.

Files only grow, or are replaced as a whole by another file of the same name. Whether a file is still
the same one is told by a checksum of its first bytes; a replaced one is read from its start.
"""

from __future__ import annotations

import fnmatch
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
# A file is known by a checksum of so many first bytes, or of all it had when first seen.
HEAD_BYTES = 256
SCHEMA = "value string, file string, position bigint"


@dataclass
class Split(InputPartition):
    """Lines of a file that begin at ``start`` or later and before ``end``; ``first`` is a line's start."""

    path: str
    start: int
    end: int
    first: bool

    def __post_init__(self):
        super().__init__(None)


def _last_line_end(source, low: int, high: int) -> int:
    """Position after the last line end between two positions, or ``low`` if there is none."""
    while high > low:
        start = max(low, high - BLOCK_BYTES)
        source.seek(start)
        at = source.read(high - start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        high = start
    return low


def _head(source, n: int) -> int:
    source.seek(0)
    return zlib.crc32(source.read(n))


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def matching_files(pattern: str) -> list[pafs.FileInfo]:
    """Files of a folder, or those whose names match the last part of a pattern."""
    fs, path = _filesystem(pattern)
    folder, _, name = path.rpartition("/")
    if not any(c in name for c in "*?["):
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [info]
        folder, name = path, "*"
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return [f for f in found if f.type == pafs.FileType.File and fnmatch.fnmatch(f.base_name, name) and f.base_name[0] not in "._"]


# How far a file was read: position, and the length and checksum of its first bytes.
Mark = list[int]


class AppendedReader(DataSourceStreamReader):
    def __init__(self, pattern: str, split_bytes: int):
        self.pattern, self.split_bytes = pattern, split_bytes
        self.seen: dict[str, tuple[int, Mark]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Marks of all files. Of a file that has not grown since the last call nothing is read."""
        fs, _ = _filesystem(self.pattern)
        out: dict[str, Mark] = {}
        for info in matching_files(self.pattern):
            known = self.seen.get(info.path)
            if known and known[0] == info.size:
                out[info.path] = known[1]
                continue
            with fs.open_input_file(info.path) as source:
                same = known and known[1][0] <= info.size and _head(source, known[1][1]) == known[1][2]
                low = known[1][0] if same else 0
                end = _last_line_end(source, low, info.size)
                # The first bytes of whole lines: they cannot change while the file only grows.
                n = known[1][1] if same and known[1][1] else min(end, HEAD_BYTES)
                out[info.path] = [end, n, _head(source, n)]
            self.seen[info.path] = (info.size, out[info.path])
        self.seen = {path: self.seen[path] for path in out}
        return out

    def partitions(self, start: dict, end: dict) -> list[Split]:
        splits = []
        for path, (until, n, head) in sorted(end.items()):
            low, before, old = start.get(path, [0, 0, 0])
            if low > until or (before and not self._unchanged(path, before, old, n, head)):
                low = 0
            for at in range(low, until, self.split_bytes):
                splits.append(Split(path, at, min(at + self.split_bytes, until), at == low))
        return splits or [Split("", 0, 0, True)]

    def _unchanged(self, path: str, before: int, old: int, n: int, head: int) -> bool:
        """Whether a file still starts with the bytes it had at its last mark."""
        if before == n:
            return old == head
        fs, _ = _filesystem(self.pattern)
        with fs.open_input_file(path) as source:
            return _head(source, before) == old

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if not split.path:
            return
        fs, _ = _filesystem(self.pattern)
        with fs.open_input_file(split.path) as source:
            yield from _lines(source, split)

    def commit(self, end: dict) -> None:
        """Nothing to do: positions live in the checkpoint."""


def _batch(split: Split, at: int, data: bytes) -> pa.RecordBatch:
    """Whole lines that begin at ``at``."""
    lines = data.split(b"\n")[:-1]
    starts, place = [], at
    for line in lines:
        starts.append(place)
        place += len(line) + 1
    values = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
    arrays = [pa.array(values, pa.string()), pa.array([split.path] * len(lines), pa.string()), pa.array(starts, pa.int64())]
    return pa.record_batch(arrays, names=["value", "file", "position"])


def _lines(source, split: Split) -> Iterator[pa.RecordBatch]:
    """A line belongs to the split in which it begins; memory holds a block and a line."""
    at = split.start
    source.seek(at)
    rest = b""
    if not split.first:
        # The line under way at the border began before it, unless the border is just behind a line end.
        source.seek(split.start - 1)
        at = split.start - 1
        while True:
            block = source.read(BLOCK_BYTES)
            if not block:
                return
            found = block.find(b"\n")
            if found >= 0:
                at, rest = at + found + 1, block[found + 1 :]
                break
            at += len(block)
    while at < split.end:
        whole = rest.rfind(b"\n") + 1
        if at + len(rest) >= split.end:
            # The line that crosses the end is the last one.
            cut = rest.find(b"\n", max(split.end - at - 1, 0))
            if cut >= 0:
                yield _batch(split, at, rest[: cut + 1])
                return
        elif whole:
            yield _batch(split, at, rest[:whole])
            at, rest = at + whole, rest[whole:]
        block = source.read(BLOCK_BYTES)
        if not block:
            return
        rest += block


class AppendedLines(DataSource):
    """Options: ``path`` (a folder, a file, or a pattern of names in a folder), ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "appended"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> AppendedReader:
        return AppendedReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def tail_appended(spark: SparkSession, pattern: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Stream of ``(value, file, position)`` from logs that still grow.

    Each line comes once, also over restarts from the query's checkpoint. A rotated file keeps being
    one file only under its name: choose a pattern that does not match the names rotation gives. The
    checkpoint holds an entry for each file there is.
    """
    spark.dataSource.register(AppendedLines)
    return spark.readStream.format("appended").option("splitBytes", split_bytes).load(pattern)
