"""A user's own accumulator (A4/U4): create, add, merge, result, for what no built-in aggregate does.

Each task folds its rows, Arrow batch by Arrow batch, into one accumulator per key, as an aggregate's partial step does; what
it has is given out as bytes, earlier if it holds many keys. Accumulators of a key are then merged as a tree: first by key and
branch, each branch some of the tasks, then by key. With about the square root of the tasks as branches no merge sees more
than that many accumulators, however hot the key.
"""

from __future__ import annotations

import pickle
import sys
from abc import ABC, abstractmethod
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pickled by value, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys of which a task holds accumulators at a time.
HELD_KEYS = 65_536


class Accumulator(ABC):
    """``merge`` must be associative and commutative, with ``create`` as its neutral element. The object that holds the
    state is the accumulator's own affair; ``dump`` and ``load`` carry it between tasks."""

    @abstractmethod
    def create(self) -> object: ...

    @abstractmethod
    def add(self, held: object, rows: pa.RecordBatch) -> object:
        """``held`` and rows of its key, the value columns of them."""

    @abstractmethod
    def merge(self, a: object, b: object) -> object: ...

    @abstractmethod
    def result(self, held: object) -> tuple:
        """The values of the result columns."""

    def dump(self, held: object) -> bytes:
        return pickle.dumps(held)

    def load(self, data: bytes) -> object:
        return pickle.loads(data)


class TopCounts(Accumulator):
    """The ``k`` greatest distinct values and how often each came, exactly: a value once out of the ``k`` greatest of some rows
    is out for good, so only those need counting. Nulls don't count. Result: the values, and their counts."""

    def __init__(self, k: int):
        self.k = k

    def create(self) -> dict:
        return {}

    def add(self, held: dict, rows: pa.RecordBatch) -> dict:
        counted = pc.value_counts(rows.column(0).drop_null())
        return self.merge(held, {e["values"]: e["counts"] for e in counted.to_pylist()})

    def merge(self, a: dict, b: dict) -> dict:
        greatest = sorted({*a, *b}, reverse=True)[:self.k]
        return {v: a.get(v, 0) + b.get(v, 0) for v in greatest}

    def result(self, held: dict) -> tuple:
        return list(held), list(held.values())


def _fold(accumulator: Accumulator):
    """Rows (key text, value columns) as (key text, branch, bytes), one row a key or a few."""
    schema = pa.schema([("_key", pa.string()), ("_task", pa.int64()), ("_held", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = TaskContext.get().partitionId(), {}

        def given_out():
            keys = list(held)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([task] * len(keys), pa.int64()),
                                              pa.array([accumulator.dump(held[k]) for k in keys], pa.binary())], schema=schema)
            held.clear()

        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            order = pc.sort_indices(keys.indices)
            sorted_rows, codes = batch.take(order).select(batch.schema.names[1:]), keys.indices.take(order).to_numpy()
            names, at = keys.dictionary.to_pylist(), 0
            while at < len(codes):
                end = at + int((codes[at:] != codes[at]).argmax() or len(codes) - at)
                key = names[codes[at]]
                held[key] = accumulator.add(held[key] if key in held else accumulator.create(), sorted_rows.slice(at, end - at))
                at = end
            if len(held) > HELD_KEYS:
                yield from given_out()
        if held:
            yield from given_out()
    return run


def accumulate(df: DataFrame, *, keys: list[str], values: list[str], accumulator: Accumulator, result: str) -> DataFrame:
    """``keys`` and the columns of the DDL ``result``: a row per key with what ``accumulator`` makes of its ``values``.

    Null keys are a key. An empty table gives no rows.
    """
    columns = T.StructType.fromDDL(result)
    kind = df.select(*keys).schema
    rows = df.select(F.to_json(F.struct(*keys)).alias("_key"), *values)
    partial = rows.mapInArrow(_fold(accumulator), "_key string, _task long, _held binary")
    branches = max(1, round(df.sparkSession.sparkContext.defaultParallelism ** 0.5))

    def merged(table: pa.Table) -> object:
        held = accumulator.create()
        for data in table.column("_held").to_pylist():
            held = accumulator.merge(held, accumulator.load(data))
        return held

    def branch(table: pa.Table) -> pa.Table:
        return pa.table({"_key": table.column("_key").slice(0, 1), "_held": pa.array([accumulator.dump(merged(table))], pa.binary())})

    def root(table: pa.Table) -> pa.Table:
        found = accumulator.result(merged(table))
        return pa.table({"_key": table.column("_key").slice(0, 1), **{f.name: pa.array([v]) for f, v in zip(columns.fields, found, strict=True)}})

    limbs = partial.groupBy("_key", F.pmod("_task", F.lit(branches)).alias("_branch")).applyInArrow(branch, "_key string, _held binary")
    out = limbs.groupBy("_key").applyInArrow(root, T.StructType([T.StructField("_key", T.StringType()), *columns.fields]))
    own = F.from_json("_key", kind)
    return out.select(*[own.getField(k).alias(k) for k in keys], *columns.names)
