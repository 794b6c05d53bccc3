"""Row operators (P1-P13): map, flatMap fan-outs, filters, projections, side outputs.

All are narrow transformations (no shuffle) over Catalyst expressions, so they
fuse into the scan's whole-stage-codegen stage. Opaque per-row code, when a user
really has some, goes through ``map_batches`` (Arrow batches, once-per-partition
setup/teardown), never a row-at-a-time UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, fizzbuzz
from ..schemas import PURCHASE_ALERT


def map_column(df: DataFrame, expr: Column, name: str, keep: list[str] | None = None) -> DataFrame:
    """One output value per row."""
    return df.select(*(keep or []), expr.alias(name))


def fan_out(df: DataFrame, values: Column, name: str, keep: list[str] | None = None) -> DataFrame:
    """flatMap to the elements of an array expression (0..n rows per input)."""
    return df.select(*(keep or []), F.explode(values).alias(name))


def fan_out_pair(df: DataFrame, n: str | Column, name: str = "m", keep: list[str] | None = None) -> DataFrame:
    """``n -> [n, n + 1]``."""
    n = col(n)
    return fan_out(df, F.array(n, n + 1), name, keep)


def fan_out_range(df: DataFrame, n: str | Column, name: str = "m", keep: list[str] | None = None) -> DataFrame:
    """``n -> 1 .. n-1`` (end-exclusive range; nothing for n <= 1).

    The guard matters: Spark's ``sequence(1, 0)`` counts *down*.
    """
    n = col(n)
    seq = F.when(n > 1, F.sequence(F.lit(1).cast("long"), n.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    return fan_out(df, seq, name, keep)


def explode_quantity(df: DataFrame, item: str = "sku", quantity: str = "quantity",
                     keep: list[str] | None = None) -> DataFrame:
    """P5: a row with quantity q becomes q rows of ``item`` (q = 0 -> none).

    ``unit`` numbers the copies 1..q so every output row is distinguishable.
    """
    q = F.col(quantity)
    units = F.when(q > 0, F.sequence(F.lit(1), q)).otherwise(F.array().cast("array<int>"))
    return df.select(*(keep or []), F.col(item), F.explode(units).alias("unit"))


def fizzbuzz_labels(df: DataFrame, n: str = "n") -> DataFrame:
    """``FizzBuzzResult(n, output)``."""
    return df.select(F.col(n).alias("n"), fizzbuzz(n).alias("output"))


def threshold_filter(df: DataFrame, value: str, threshold: int | Column) -> DataFrame:
    """Strict ``value > threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.filter(F.col(value) > t)


def purchase_message(user: Column, quantity: Column, sku: Column, threshold: Column) -> Column:
    """The alert text of the threshold demos."""
    return F.format_string(PURCHASE_ALERT, user.cast("string"), quantity.cast("string"), sku, threshold.cast("string"))


def split_stream(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """P13 side output: (main, side) — a disjoint cover of ``df``.

    A null predicate counts as false, so the row goes to the main output.
    Downstream of a costly source, persist/checkpoint ``df`` (or use
    ``foreachBatch`` in streaming) so it is read once for both outputs.
    """
    p = F.coalesce(pred, F.lit(False))
    return df.filter(~p), df.filter(p)


def map_batches(df: DataFrame, fn: Callable[[Iterator], Iterator], schema, *,
                setup: Callable[[], object] | None = None,
                teardown: Callable[[object], None] | None = None) -> DataFrame:
    """U2 rich function: ``open`` once per partition, per-batch work, ``close`` in ``finally``.

    ``fn(batches, resource)`` receives an iterator of pyarrow RecordBatches.
    """
    def run(batches):
        res = setup() if setup else None
        try:
            yield from fn(batches, res)
        finally:
            if teardown:
                teardown(res)
    return df.mapInArrow(run, schema)
