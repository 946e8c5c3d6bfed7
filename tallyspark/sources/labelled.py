"""Labelled lines as a data source: ``label:value`` fields parted by tabs, one row a line.

    register(spark)
    df.write.format("labelled").mode("append").save(folder)
    spark.read.format("labelled").schema("id long, name string, _bad string").load(folder)
    spark.readStream.format("labelled")...; stream.writeStream.format("labelled")...

Null fields are left out, so a missing label reads as null. Backslash, tab, line
feed and carriage return inside a value are written as ``\\\\``, ``\\t``, ``\\n``, ``\\r``.
A line that doesn't parse (a field without a label, a value that isn't of its
column's type) is kept whole in the column ``_bad``, if the schema has one, with
all others null; without that column it is dropped. Labels that the schema lacks
are passed over. Types: string, int, long, double, boolean, timestamp_ntz.

Files are read in ranges of bytes (option ``splitBytes``); a range has the lines
that begin in it. Writers write a file for each task under a name that starts
with a dot, which readers pass over, and rename it on commit. A stream's offset is
the names of the files it has seen, its files are named by micro-batch, and a
micro-batch that is committed again replaces its own files. The folder may be in
any store that Arrow opens by its address.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BAD = "_bad"
_ESCAPES = {"\\": "\\\\", "\t": "\\t", "\n": "\\n", "\r": "\\r"}
_BACK = {v[1]: k for k, v in _ESCAPES.items()}
_SPECIAL = re.compile(r"[\\\t\n\r]")
_ESCAPED = re.compile(r"\\(.)")


def _truth(text: str) -> bool:
    return {"true": True, "false": False}[text]


_PARSERS = {
    "string": str, "int": int, "bigint": int, "double": float, "boolean": _truth, "timestamp_ntz": datetime.fromisoformat,
}


def _shown(value: object) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return _SPECIAL.sub(lambda m: _ESCAPES[m[0]], str(value))


def _parsed(line: str, parsers: dict) -> dict:
    """The fields of a line by label; ValueError or KeyError if it doesn't parse."""
    row = {}
    for field in line.split("\t") if line else ():
        label, mark, value = field.partition(":")
        if not mark or label in row:
            raise ValueError(line)
        if label in parsers:
            value = parsers[label](_ESCAPED.sub(lambda m: _BACK[m[1]], value))
            if isinstance(value, int) and not isinstance(value, bool) and not -(1 << 63) <= value < 1 << 63:
                raise ValueError(line)
        row[label] = value
    return row


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder) if ":/" in folder else f"file://{folder}")


def _files(folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the finished files, by name."""
    store, path = _opened(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._" and f.size)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class _Ranges:
    """What the batch and the stream reader share."""

    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.folder = schema, options["path"]
        self.split = int(options.get("splitbytes") or options.get("splitBytes") or 32 << 20)

    def ranges(self, files: list[tuple[str, int]]) -> list[Range]:
        return [Range(path, at, min(at + self.split, size)) for path, size in files for at in range(0, size, self.split)]

    def _lines(self, part: Range) -> Iterator[str]:
        store, _ = _opened(self.folder)
        with store.open_input_file(part.path) as f:
            at = max(0, part.start - 1)
            f.seek(at)
            rest, own = b"", not part.start  # the first line belongs to the range before, if only by its end
            data = b"?"
            while data:
                data = f.read(1 << 20)
                lines = (rest + data).split(b"\n")
                rest = lines.pop() if data or not lines[-1] else b""
                for line in lines:
                    if at >= part.end:
                        return
                    if own:
                        yield line.decode("utf-8", "replace")
                    at, own = at + len(line) + 1, True

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(self.schema)
        parsers = {f.name: _PARSERS[f.dataType.simpleString()] for f in self.schema if f.name != BAD}
        rows: list[dict] = []
        for line in self._lines(partition):
            try:
                rows.append(_parsed(line, parsers))
            except (ValueError, KeyError, OverflowError):
                if BAD in types.names:
                    rows.append({BAD: line})
            if len(rows) >= 10_000:
                yield self._batch(rows, types)
                rows = []
        if rows:
            yield self._batch(rows, types)

    @staticmethod
    def _batch(rows: list[dict], types: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in types], schema=types)


class _Reader(_Ranges, DataSourceReader):
    def partitions(self) -> list[Range]:
        return self.ranges(_files(self.folder)) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return super().read(partition) if partition.path else iter(())


class _StreamReader(_Ranges, DataSourceStreamReader):
    """The offset is the list of files seen."""

    def initialOffset(self) -> dict:
        return {"seen": []}

    def latestOffset(self) -> dict:
        return {"seen": [path for path, _ in _files(self.folder)]}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        new = set(end["seen"]) - set(start["seen"])
        return self.ranges([f for f in _files(self.folder) if f[0] in new])


class _Files:
    """What the batch and the stream writer share: a hidden file for each task, renamed on commit."""

    def __init__(self, options: dict) -> None:
        self.folder = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = _opened(self.folder)
        store.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.labelled"
        rows = 0
        with store.open_output_stream(f"{path}/.{name}") as out:
            for batch in iterator:
                names, rows = batch.schema.names, rows + batch.num_rows
                for values in zip(*(c.to_pylist() for c in batch.columns)):
                    fields = [f"{n}:{_shown(v)}" for n, v in zip(names, values) if v is not None and n != BAD]
                    out.write(("\t".join(fields) + "\n").encode())
        return Written([name] if rows else [])

    def rename(self, messages: list, stem: str) -> list[str]:
        store, path = _opened(self.folder)
        made = [f"{path}/{stem}{name}" for m in messages if m for name in m.names]
        for to in made:
            store.move(f"{path}/.{to.rpartition(stem)[2] if stem else to.rpartition('/')[2]}", to)
        return made

    def drop(self, messages: list) -> None:
        store, path = _opened(self.folder)
        for m in messages:
            for name in m.names if m else ():
                if store.get_file_info(f"{path}/.{name}").type == fs.FileType.File:
                    store.delete_file(f"{path}/.{name}")


class _Writer(_Files, DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        super().__init__(options)
        self.overwrite = overwrite

    def commit(self, messages: list) -> None:
        old = [path for path, _ in _files(self.folder)] if self.overwrite else []
        self.rename(messages, "")
        store, _ = _opened(self.folder)
        for path in old:
            store.delete_file(path)

    def abort(self, messages: list) -> None:
        self.drop(messages)


class _StreamWriter(_Files, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        stem = f"batch-{batchId:012d}-"
        old = [path for path, _ in _files(self.folder) if path.rpartition("/")[2].startswith(stem)]
        self.rename(messages, stem)
        store, _ = _opened(self.folder)
        for path in old:  # of a commit that was not recorded
            store.delete_file(path)

    def abort(self, messages: list, batchId: int) -> None:
        self.drop(messages)


class LabelledLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "labelled"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options)


def register(spark: SparkSession) -> SparkSession:
    """Make the format ``labelled`` known to a session."""
    spark.dataSource.register(LabelledLines)
    return spark
