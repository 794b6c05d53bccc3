"""A source and a sink of text lines on Spark's Python data source interface.

The source is a folder of text files, laid down in name order (a file must sort after those that were there before it). Its
offset is the name of the last file that was read; each range of bytes of a file is a partition, so a large file is
read by many tasks. The sink stages what each task writes under a name of its own; ``commit`` moves the
staged files to the micro-batch's folder, ``abort`` removes them, and a micro-batch that runs again
replaces its folder. Both open paths with Arrow's file systems, so the folders must be on one that all machines share.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

# Pickled by value, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 64 << 20
READ_BYTES = 1 << 20
STAGED = "_staged"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(uri)
    return system, path.rstrip("/")


def _files(uri: str) -> list[tuple[str, int]]:
    """(name under the folder, bytes) of its files in name order; hidden ones don't count."""
    system, path = _opened(uri)
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    named = sorted((f.path[len(path) + 1:], f.size) for f in found if f.type == fs.FileType.File)
    return [(name, size) for name, size in named if not any(part.startswith(("_", ".")) for part in name.split("/"))]


@dataclass
class Stretch(InputPartition):
    """The lines of a file that begin in the bytes [start, end)."""
    name: str
    start: int
    end: int


class LineReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.uri, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        return {"last": max((name for name, _ in _files(self.uri)), default="")}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        own = [(name, size) for name, size in _files(self.uri) if start["last"] < name <= end["last"]]
        return [Stretch(name, at, min(at + self.split, size)) for name, size in own for at in range(0, size, self.split)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        system, path = _opened(self.uri)
        with system.open_input_file(f"{path}/{partition.name}") as file:
            at, held = partition.start, b""
            if at:  # the line that is under way here belongs to the stretch before, unless one has just ended
                at -= 1
                file.seek(at)
                while True:
                    block = file.read(READ_BYTES)
                    cut = block.find(b"\n")
                    if cut >= 0 or not block:
                        at, held = (at + cut + 1, block[cut + 1:]) if cut >= 0 else (partition.end, b"")
                        break
                    at += len(block)
            while at < partition.end:  # ``held`` begins at ``at``
                *lines, rest = held.split(b"\n")
                taken = []
                for line in lines:
                    if at >= partition.end:
                        break
                    taken.append(line)
                    at += len(line) + 1
                if taken:
                    yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace") for x in taken], pa.string())], names=["line"])
                if at >= partition.end:
                    return
                block = file.read(READ_BYTES)
                if not block:
                    if rest:
                        yield pa.RecordBatch.from_arrays([pa.array([rest.decode("utf-8", "replace")], pa.string())], names=["line"])
                    return
                held = rest + block

    def commit(self, end: dict) -> None:
        """Files stay where they are: others may read them too."""


@dataclass
class Staged(WriterCommitMessage):
    name: str
    lines: int


class LineWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.uri = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, path = _opened(self.uri)
        system.create_dir(f"{path}/{STAGED}", recursive=True)
        name, n = f"{STAGED}/{uuid.uuid4().hex}", 0
        with system.open_output_stream(f"{path}/{name}") as out:
            for batch in iterator:
                lines = ["" if x is None else x for x in batch.column(0).to_pylist()]
                out.write("".join(f"{x}\n" for x in lines).encode())
                n += len(lines)
        return Staged(name, n)

    def commit(self, messages: list, batchId: int) -> None:
        system, path = _opened(self.uri)
        folder = f"{path}/batch={batchId:09d}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)
        system.create_dir(folder, recursive=True)
        for i, m in enumerate(m for m in messages if m is not None):
            if m.lines:
                system.move(f"{path}/{m.name}", f"{folder}/part-{i:05d}.txt")
            else:
                system.delete_file(f"{path}/{m.name}")

    def abort(self, messages: list, batchId: int) -> None:
        system, path = _opened(self.uri)
        for m in messages:
            if m is not None and system.get_file_info(f"{path}/{m.name}").type == fs.FileType.File:
                system.delete_file(f"{path}/{m.name}")


class LineLog(DataSource):
    """``spark.readStream.format("line_log").load(folder)`` and ``df.writeStream.format("line_log").option("path", folder)``:
    one column ``line``; a null line is written as an empty one."""

    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> str:
        return "line string"

    def streamReader(self, schema) -> LineReader:
        return LineReader(self.options)

    def streamWriter(self, schema, overwrite: bool) -> LineWriter:
        return LineWriter(self.options)
