"""A stream of lines from files that grow: what is appended is read, whatever was read before.

The position in the stream is the number of bytes read of each file. It always lies behind a line
end, so a line that is still being written waits for its end, and a restarted query goes on at the
byte where its checkpoint stands. A large piece is cut into several readers; a line belongs to the
reader in whose piece it begins.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from footfall.session import importable

FORMAT = "growing_text"
#: Bytes per reader, and bytes held at a time by one.
SPLIT_BYTES, BLOCK_BYTES = 64 << 20, 4 << 20
LINES = pa.schema([("value", pa.string()), ("file", pa.string()), ("position", pa.int64())])


class Place(NamedTuple):
    """A folder on the file system its address names: local or shared folders as plain paths,
    object stores and others as far as pyarrow knows them."""

    system: fs.FileSystem
    folder: str

    @classmethod
    def of(cls, path: str) -> Place:
        if "://" in path:
            return cls(*fs.FileSystem.from_uri(path))
        return cls(fs.LocalFileSystem(), path.removeprefix("file:"))

    def sizes(self, suffix: str) -> dict[str, int]:
        """Bytes of each file below the folder, by its path there; hidden ones are left out."""
        wanted = fs.FileSelector(self.folder, allow_not_found=True, recursive=True)
        found = {}
        for info in self.system.get_file_info(wanted):
            name = info.path[len(self.folder.rstrip("/")) + 1 :]
            hidden = any(part.startswith((".", "_")) for part in name.split("/"))
            if info.is_file and name.endswith(suffix) and not hidden:
                found[name] = info.size
        return found

    def open(self, name: str) -> pa.NativeFile:
        return self.system.open_input_file(f"{self.folder.rstrip('/')}/{name}")


def last_line_end(file: pa.NativeFile, start: int, size: int) -> int:
    """The place behind the last line end in ``start..size``; ``start`` if there is none."""
    end = size
    while end > start:
        begin = max(start, end - BLOCK_BYTES)
        at = file.read_at(end - begin, begin).rfind(b"\n")
        if at >= 0:
            return begin + at + 1
        end = begin
    return start


class Piece(InputPartition):
    """Lines that begin in ``start..stop`` of a file that is complete up to ``end``."""

    def __init__(self, name: str, start: int, stop: int, end: int, aligned: bool):
        self.name, self.start, self.stop, self.end = name, start, stop, end
        self.aligned = aligned


def pieces(name: str, start: int, end: int, split: int) -> list[Piece]:
    cuts = [*range(start, end, split), end]
    return [Piece(name, a, b, end, a == start) for a, b in zip(cuts, cuts[1:])]


def lines_of(file: pa.NativeFile, piece: Piece) -> Iterator[tuple[list[bytes], list[int]]]:
    """Lines and their places, a block at a time."""
    at, rest = piece.start, b""
    if not piece.aligned:
        # The byte before tells whether a line begins right here.
        skipped = piece.start - 1
        while True:
            block = file.read_at(min(BLOCK_BYTES, piece.end - skipped), skipped)
            found = block.find(b"\n")
            if found >= 0 or not block:
                break
            skipped += len(block)
        if not block:
            return
        at = skipped + found + 1
    read = at
    while at < piece.stop and read < piece.end:
        block = file.read_at(min(BLOCK_BYTES, piece.end - read), read)
        if not block:
            return
        read += len(block)
        *whole, rest = (rest + block).split(b"\n")
        lines, places = [], []
        for line in whole:
            if at >= piece.stop:
                break
            places.append(at)
            at += len(line) + 1
            lines.append(line.removesuffix(b"\r"))
        if lines:
            yield lines, places


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.suffix = options.get("suffix", "")
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.ends: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        """The ends of all files; only of those that have grown is the tail read."""
        place = Place.of(self.path)
        ends = {}
        for name, size in sorted(place.sizes(self.suffix).items()):
            known = self.ends.get(name, 0)
            known = known if known <= size else 0
            if size > known:
                with place.open(name) as file:
                    known = last_line_end(file, known, size)
            if known:
                ends[name] = known
        self.ends = ends
        return {"files": json.dumps(ends)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        found = []
        for name, stop in after.items():
            begin = before.get(name, 0)
            # A file that has become shorter is another one under the same name.
            begin = begin if begin <= stop else 0
            if begin < stop:
                found += pieces(name, begin, stop, self.split)
        return found

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        with Place.of(self.path).open(partition.name) as file:
            for lines, places in lines_of(file, partition):
                values = [line.decode("utf-8", "replace") for line in lines]
                names = [partition.name] * len(lines)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, pa.string()), pa.array(names), pa.array(places, pa.int64())],
                    schema=LINES,
                )

    def commit(self, end: dict) -> None:
        pass


class GrowingText(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, file string, position bigint"

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self.options)


def stream_growing_files(
    spark: SparkSession, path: str, suffix: str = "", split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """``value file position``: the lines of all files below ``path``, also of those to come.

    Files may appear and grow, also while the query stands still; what is written in them must
    not change. A file that has become shorter is read from its start again. A line without an
    end is not read yet. ``position`` is the byte at which a line begins, so with ``file`` it
    names the line for good. Bytes that are no UTF-8 are replaced. All workers must see ``path``.
    """
    importable(spark)
    spark.dataSource.register(GrowingText)
    reader = spark.readStream.format(FORMAT).option("suffix", suffix)
    return reader.option("splitBytes", split_bytes).option("path", path).load()
