"""Arrow helpers that run in Python workers."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa


def kept_by_worker(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in each Python worker: the next tasks there find it again."""
    name = "_tidemark_kept"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    kept = vars(sys.modules[name])
    if key not in kept:
        kept[key] = make()
    return kept[key]


def texts(batch: pa.RecordBatch) -> list[str]:
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def record_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``size`` rows."""
    columns: list[list] = [[] for _ in schema]
    for row in rows:
        for column, value in zip(columns, row, strict=True):
            column.append(value)
        if len(columns[0]) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            columns = [[] for _ in schema]
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def parts(items: list, size: int) -> Iterator[list]:
    for i in range(0, len(items), size):
        yield items[i:i + size]
