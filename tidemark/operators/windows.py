"""Event-time windows and window aggregations.

Tumbling and sliding windows are Spark's ``window()`` grouping expression: the
aggregation runs partial-then-final (map-side combine), so a window holding a
third of the rows still leaves each task as one partial row. The same functions
accept streaming DataFrames (after ``withWatermark``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_window(df: DataFrame, col: str = "window", prefix: str = "window") -> DataFrame:
    """``window`` struct -> ``window_start``, ``window_end`` (stable flat schema)."""
    others = [c for c in df.columns if c != col]
    return df.select(F.col(f"{col}.start").alias(f"{prefix}_start"),
                     F.col(f"{col}.end").alias(f"{prefix}_end"), *others)


def window_col(ts: str, size: str, slide: str | None = None, start_offset: str | None = None) -> Column:
    """Epoch-aligned tumbling (``slide`` None) or sliding window assignment."""
    if slide is None and start_offset is None:
        return F.window(ts, size)
    return F.window(ts, size, slide or size, start_offset)


def window_aggregate(df: DataFrame, ts: str, size: str, aggs: list[Column], *,
                     slide: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Generic window function (A4): built-in aggregates with partial + final merge.

    Windows that contain rows but none matching a conditional aggregate emit 0;
    windows without rows emit nothing (the reference's behaviour).
    """
    keys = keys or []
    out = df.groupBy(*[F.col(k) for k in keys], window_col(ts, size, slide).alias("window")).agg(*aggs)
    return flatten_window(out)


def count_matching(pred: Column, name: str) -> Column:
    return F.count_if(pred).alias(name)


def tumbling_counts(df: DataFrame, ts: str, size: str, pred: Column | None = None,
                    keys: list[str] | None = None, count_name: str = "n") -> DataFrame:
    """Rows per tumbling window; with ``pred`` also the rows matching it."""
    if pred is None:
        aggs = [F.count(F.lit(1)).alias(count_name)]
    else:
        aggs = [count_matching(pred, count_name), F.count(F.lit(1)).alias("events")]
    return window_aggregate(df, ts, size, aggs, keys=keys)


def sliding_counts(df: DataFrame, ts: str, size: str, slide: str, pred: Column | None = None,
                   count_name: str = "n") -> DataFrame:
    """Each row counts in size/slide overlapping windows."""
    aggs = [F.count(F.lit(1)).alias("events")]
    if pred is not None:
        aggs.insert(0, count_matching(pred, count_name))
    return window_aggregate(df, ts, size, aggs, slide=slide)


def busiest_window(windowed: DataFrame, count_col: str, k: int = 1) -> DataFrame:
    """A8 arg-max, kept distributed: top-k by count, earliest start first on ties.

    Plans as TakeOrderedAndProject (per-partition top-k, then a k-row merge), so
    only k rows per task travel; the reference collected every window to the client.
    """
    return windowed.orderBy(F.col(count_col).desc(), F.col("window_start").asc()).limit(k)


def mergeable_aggregate(df: DataFrame, ts: str, size: str, partials: dict[str, Column],
                        finish: dict[str, Column], *, keys: list[str] | None = None,
                        slide: str | None = None) -> DataFrame:
    """A4/U4 ``AggregateFunction`` (createAccumulator / add / merge / getResult).

    The accumulator is a set of built-in aggregates (``partials``: name -> agg
    column), which Spark computes map-side and merges after the shuffle; ``finish``
    (name -> expression over the partial names) is ``getResult``. A custom
    accumulator therefore never gathers a window's rows in one task, which a
    grouped pandas UDF would.
    """
    out = window_aggregate(df, ts, size, [c.alias(n) for n, c in partials.items()], keys=keys, slide=slide)
    return out.select(*(keys or []), "window_start", "window_end", *[c.alias(n) for n, c in finish.items()])


def with_ingest_time(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Processing time, taken once per micro-batch (``current_timestamp``)."""
    return df.withColumn(name, F.current_timestamp())


def processing_time_counts(df: DataFrame, size: str, name: str = "ingest_ts") -> DataFrame:
    """T9 ``TumblingProcessingTimeWindows``: counts per wall-clock window of arrival.

    Non-deterministic by design; tests run the same operator on a recorded
    ingest-time column instead."""
    d = df if name in df.columns else with_ingest_time(df, name)
    return window_aggregate(d, name, size, [F.count(F.lit(1)).alias("events")])
