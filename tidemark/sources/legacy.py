"""A legacy export as a data source: files of JSON lines in key order, which answer key ranges and nothing else.

Each file is cut into stretches of bytes that tasks read side by side. The first key of each stretch is looked up before,
so stretches outside the bounds that Spark pushes down are not read at all; all other predicates stay with Spark. As a
stream the source is polled by key: an offset is the highest key that was there, a batch the keys above the one before.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

BLOCK = 32 << 20  # bytes a task reads
ROWS = 10_000  # rows of an Arrow batch
LOOK = 1 << 16  # bytes read at once while the first line of a stretch is looked for


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Bounds:
    """Keys that are wanted; either end may be open. ``above`` is excluded, ``low`` and ``high`` are included."""

    low: int | None = None
    above: int | None = None
    high: int | None = None
    below: int | None = None

    def holds(self, key: int) -> bool:
        return (
            (self.low is None or key >= self.low) and (self.above is None or key > self.above)
            and (self.high is None or key <= self.high) and (self.below is None or key < self.below)
        )

    def meets(self, first: int, last: int | None) -> bool:
        """Whether keys from ``first`` to ``last`` (open where None) may be wanted."""
        starts = self.high is None or first <= self.high
        starts = starts and (self.below is None or first < self.below)
        ends = last is None or ((self.low is None or last >= self.low) and (self.above is None or last > self.above))
        return starts and ends


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int
    bounds: Bounds

    def __init__(self, path: str, start: int, end: int, bounds: Bounds):
        super().__init__((path, start, end))
        self.path, self.start, self.end, self.bounds = path, start, end, bounds


class Export:
    """What the file reader and the stream share: path, key column and schema."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, dict(options)
        self.path, self.key = options["path"], options["key"]
        self.block = int(options.get("block", BLOCK))
        if self.key not in schema.fieldNames():
            raise ValueError(f"the schema has no key column {self.key}")

    def files(self) -> list[tuple[str, int]]:
        fs, path = opened(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        names = [(f.path, f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._" and f.size]
        return sorted(names)

    def key_of(self, line: bytes) -> int:
        return int(json.loads(line)[self.key])

    def first_key(self, file: pa.NativeFile, at: int, size: int) -> tuple[int, int] | None:
        """Place and key of the first line that begins at or after ``at``."""
        begin = max(0, at - 1)
        file.seek(begin)
        held = b""
        while True:
            more = file.read(LOOK)
            held += more
            skip = 0 if at == 0 else held.find(b"\n") + 1
            if at == 0 or skip:
                end = held.find(b"\n", skip)
                if end >= 0 or not more:
                    line = held[skip:end if end >= 0 else len(held)]
                    return (begin + skip, self.key_of(line)) if line.strip() else None
            elif not more:
                return None

    def stretches(self, bounds: Bounds) -> list[Stretch]:
        """Stretches of all files that may hold wanted keys. Only one line of each is read for that."""
        fs, _ = opened(self.path)
        out = []
        for path, size in self.files():
            with fs.open_input_file(path) as file:
                firsts = [f for at in range(0, size, self.block) if (f := self.first_key(file, at, size))]
            starts = sorted(set(firsts))
            for k, (at, key) in enumerate(starts):
                last = starts[k + 1][1] if k + 1 < len(starts) else None
                if bounds.meets(key, last):
                    out.append(Stretch(path, at, starts[k + 1][0] if k + 1 < len(starts) else size, bounds))
        return out

    def rows(self, stretch: Stretch) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.path)
        arrow, held = to_arrow_schema(self.schema), []
        times = [(f.name, f.dataType) for f in self.schema if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]
        with fs.open_input_file(stretch.path) as file:
            file.seek(stretch.start)
            left, rest = stretch.end - stretch.start, b""
            while left > 0 or rest:
                more = file.read(min(left, 1 << 20)) if left > 0 else b""
                left = left - len(more) if more else 0
                lines = (rest + more).split(b"\n")
                rest = lines.pop() if left > 0 else b""
                for line in lines:
                    if not line.strip():
                        continue
                    row = json.loads(line)
                    if not stretch.bounds.holds(int(row[self.key])):
                        continue
                    for name, kind in times:
                        if row.get(name) is not None:
                            row[name] = (date if isinstance(kind, DateType) else datetime).fromisoformat(row[name])
                    held.append(row)
                    if len(held) == ROWS:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)


class LegacyReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.export, self.bounds = Export(schema, options), Bounds()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of the key with a whole number; hands back all else."""
        b = self.bounds
        most = lambda old, new: new if old is None else max(old, new)
        least = lambda old, new: new if old is None else min(old, new)
        for f in filters:
            ours = getattr(f, "attribute", None) == (self.export.key,)
            value = getattr(f, "value", None)
            if ours and isinstance(f, IsNotNull):
                continue  # a line without a key has no place in the export
            if not ours or isinstance(value, bool) or not isinstance(value, int):
                yield f
            elif isinstance(f, GreaterThan):
                b.above = most(b.above, value)
            elif isinstance(f, GreaterThanOrEqual):
                b.low = most(b.low, value)
            elif isinstance(f, LessThan):
                b.below = least(b.below, value)
            elif isinstance(f, LessThanOrEqual):
                b.high = least(b.high, value)
            elif isinstance(f, EqualTo):
                b.low, b.high = most(b.low, value), least(b.high, value)
            else:
                yield f

    def partitions(self) -> list[Stretch]:
        return self.export.stretches(self.bounds)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Stretch):  # Spark asks for one empty partition where there is none
            yield from self.export.rows(partition)


class LegacyStream(DataSourceStreamReader):
    """Polling by key. Offsets are {"key": highest key}, so runs read disjoint ranges of keys and a batch that failed is
    read again with the same bounds. Keys have to rise with time: lower ones that come later wait for a reconcile."""

    def __init__(self, schema: StructType, options: dict):
        self.export = Export(schema, options)

    def initialOffset(self) -> dict:
        return {"key": int(self.export.options.get("after", -(1 << 63)))}

    def latestOffset(self) -> dict:
        fs, _ = opened(self.export.path)
        top = self.initialOffset()["key"]
        for path, size in self.export.files():
            # Files are in key order, so the last line has the highest key.
            with fs.open_input_file(path) as file:
                at = size
                while at > 0:
                    at = max(0, at - LOOK)
                    file.seek(at)
                    lines = [x for x in file.read(size - at).split(b"\n") if x.strip()]
                    if len(lines) > 1 or (at == 0 and lines):
                        top = max(top, self.export.key_of(lines[-1]))
                        break
        return {"key": top}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return self.export.stretches(Bounds(above=start["key"], high=end["key"])) if end["key"] > start["key"] else []

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        yield from self.export.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class LegacySource(DataSource):
    """Format ``legacy_export`` with options ``path``, ``key`` (a column of whole numbers), ``block`` (bytes of a task)
    and, for streams, ``after`` (keys up to it are not read). The schema has to be given."""

    @classmethod
    def name(cls) -> str:
        return "legacy_export"

    def reader(self, schema: StructType) -> LegacyReader:
        return LegacyReader(schema, self.options)

    def streamReader(self, schema: StructType) -> LegacyStream:
        return LegacyStream(schema, self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and lets Spark push predicates into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LegacySource)


def read_export(spark: SparkSession, path: str, schema: StructType, key: str, stream: bool = False, **options):
    register(spark)
    reader = (spark.readStream if stream else spark.read).format(LegacySource.name()).schema(schema)
    return reader.options(path=path, key=key, **options).load()
