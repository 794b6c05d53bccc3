"""Replayable stream inputs and a run-to-completion helper.

The reference's sources are wall-clock generators, sockets and Kafka. Here a
stream is something Structured Streaming can replay exactly:

* ``stage_time_slices`` lands a table as time slices (one parallel append job per
  slice, so file modification order follows event time), read back with
  ``file_stream`` one slice per micro-batch, the way a landing zone fills up;
* ``line_stream`` reads text lines (S6, re-aimed from a raw socket).

``run_available_now`` drives a streaming query over everything available with a
checkpoint in the shared checkpoint folder and returns its file-sink output as a
batch DataFrame (read through the sink's commit log, so only committed files).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_micros
from ..session import scratch_path


def time_slices(df: DataFrame, ts: str, n_slices: int) -> list[tuple]:
    """[from, to) bounds of ``n_slices`` slices of about equally many rows (fewer if times repeat); the last has no end.

    Rows without a time are between no bounds.
    """
    cuts = [i / n_slices for i in range(1, n_slices)]
    found = df.agg(F.min(ts).alias("lo"), F.percentile_approx(epoch_micros(ts), F.array(*[F.lit(c) for c in cuts]), F.lit(10_000)).alias("cuts")).first()
    if found["lo"] is None:
        return []
    epoch = dt.datetime(1970, 1, 1)
    starts = sorted({found["lo"], *[epoch + dt.timedelta(microseconds=c) for c in found["cuts"]]})
    return list(zip(starts, [*starts[1:], None], strict=True))


def landing_slices(df: DataFrame, ts: str, n_slices: int) -> list[tuple]:
    """``time_slices`` that hold every row: the first has no beginning (None), and rows without a time are in it, as they
    come first in the batch operators."""
    slices = time_slices(df, ts, n_slices) or ([] if df.isEmpty() else [(None, None)])
    return [(None if i == 0 else a, b) for i, (a, b) in enumerate(slices)]


def _within(ts: str, a, b) -> Column:
    """Whether a row is in the slice from ``a`` to ``b``; rows without a time are in the one without a beginning."""
    t = F.col(ts)
    inside = F.lit(True) if b is None else t < F.lit(b)
    return t.isNull() | inside if a is None else (t >= F.lit(a)) & inside


def stage_time_slices(df: DataFrame, path: str, *, ts: str, n_slices: int,
                      only: range | None = None, files_per_slice: int | None = None) -> int:
    """Land ``df`` as time slices of about equally many rows, slice i strictly before slice i+1.

    Each slice is written by ``k`` parallel tasks as ``k`` files, one job per slice, so every file of
    slice i is older than any file of slice i+1. Read back with ``maxFilesPerTrigger = k``, each
    micro-batch is one slice, in event-time order. Rows are dealt in turn, and ``k`` is no more than the rows that
    the fullest input split of the smallest slice has at least, so no file is empty. Returns ``k``.
    ``only`` lands a subset of the slices (e.g. the first half now, the rest after a restart). Slices are
    chosen by bounds on ``ts`` itself, which parquet can prune by.
    """
    spark = df.sparkSession
    slices = landing_slices(df, ts, n_slices)
    if not slices:
        return 1
    parts = [df.filter(_within(ts, a, b)) for a, b in slices]
    index = F.lit(0)
    for a, _ in slices[1:]:
        index = index + F.coalesce(F.col(ts) >= F.lit(a), F.lit(False)).cast("int")
    least = df.groupBy(index.alias("s")).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
    k = files_per_slice or spark.sparkContext.defaultParallelism
    k = max(1, min(k, least // max(1, df.rdd.getNumPartitions())))
    for i in (only if only is not None else range(len(slices))):
        if i < len(slices):
            parts[i].repartition(k).write.mode("append").parquet(path)
    return k


def stage_slices(df: DataFrame, path: str, index: Column, n: int) -> int:
    """Land the rows whose ``index`` is 0, then 1, up to ``n`` - 1: one micro-batch each when read back with the number of
    files that is returned (the same as in ``stage_time_slices``)."""
    counts = df.groupBy(index.alias("s")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("s").between(0, n - 1))
    least = counts.agg(F.min("n")).first()[0] or 1
    k = max(1, min(df.sparkSession.sparkContext.defaultParallelism, least // max(1, df.rdd.getNumPartitions())))
    for i in range(n):
        df.filter(index == i).repartition(k).write.mode("append").parquet(path)
    return k


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for a stream, with the settings of ``spark`` and as many state partitions as the cluster has cores
    (``spark.tidemark.streaming.shufflePartitions``): a stateful query fixes that number when it starts first,
    then keeps it in its checkpoint. No other query of ``spark`` sees the setting.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.tidemark.streaming.shufflePartitions", None) or str(spark.sparkContext.defaultParallelism))
    return own


def file_stream(spark: SparkSession, path: str, schema: T.StructType, *, files_per_batch: int = 1,
                fmt: str = "parquet") -> DataFrame:
    return (stream_session(spark).readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", files_per_batch).load(path))


def line_stream(spark: SparkSession, path: str, *, files_per_batch: int = 1) -> DataFrame:
    """One ``line`` string per row, from text files landing in ``path``."""
    return (stream_session(spark).readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
            .load(path).withColumnRenamed("value", "line"))


def event_time(c: str) -> Column:
    """``withWatermark`` needs TIMESTAMP (not NTZ): reinterpret the NTZ value as UTC."""
    return F.col(c).cast("timestamp")


def to_ntz(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def watermark_drops(query) -> int:
    """T7 late-data accounting: rows the stateful operators dropped as late, summed
    over the query's retained progress reports (``numRowsDroppedByWatermark``)."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            total += (op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict)
                      else getattr(op, "numRowsDroppedByWatermark", 0))
    return total


def run_available_now(spark: SparkSession, stream: DataFrame, name: str, *, output_mode: str = "append",
                      checkpoint: str | None = None, path: str | None = None,
                      on_done=None) -> DataFrame:
    """Run ``stream`` over all available input into a parquet file sink; return the output.

    ``on_done(query)`` sees the finished query (progress, late-row counts)."""
    path = path or scratch_path(spark, "streams", name)
    checkpoint = checkpoint or path + "_checkpoint"
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", path).option("checkpointLocation", checkpoint)
         .queryName(f"{name}_{abs(hash(path)) % 10**8}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if on_done is not None:
        on_done(q)
    return spark.read.schema(stream.schema).parquet(path)
