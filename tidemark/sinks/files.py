"""File sinks (K1-K4, K9) for batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def render_row(df: DataFrame, name: str | None = None) -> Column:
    """A row as text: ``Name(v1,v2,...)`` (case-class style) or ``v1,v2`` without a name."""
    body = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])
    return F.concat(F.lit(f"{name}("), body, F.lit(")")) if name else body


def write_text(df: DataFrame, path: str, *, parallelism: int | None = None, mode: str = "overwrite",
               name: str | None = None) -> None:
    """K2 ``writeAsText(path).setParallelism(n)``: one line per row; n files (a directory)."""
    lines = df.select(render_row(df, name).alias("value"))
    if parallelism:
        lines = lines.repartition(parallelism)  # limits the sink's tasks only, not those above it
    lines.write.mode(mode).text(path)


def append_text(df: DataFrame, path: str, name: str | None = None) -> None:
    """K4: append lines to a directory (one writer per task; files are added, never edited)."""
    write_text(df, path, mode="append", name=name)


def show(df: DataFrame, n: int = 20) -> None:
    """K1 ``print()`` for bounded output."""
    df.show(n, truncate=False)


def console_stream(stream: DataFrame, *, output_mode: str = "append", trigger: str | None = None,
                   checkpoint: str | None = None, available_now: bool = False):
    """K1 for streams: the console sink, checkpointed in the shared checkpoint folder
    (Spark would otherwise pick a machine-local temporary one)."""
    from ..session import scratch_path
    w = (stream.writeStream.format("console").outputMode(output_mode).option("truncate", "false")
         .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "console")))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def stream_to_files(stream: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet",
                    trigger: str | None = None, available_now: bool = False, name: str | None = None):
    """K3 streaming row-format file sink: files are committed atomically per micro-batch
    through the sink's metadata log and the checkpoint (exactly once), so readers never
    see in-progress files. ``fmt="text"`` needs a single string column."""
    w = (stream.writeStream.format(fmt).outputMode("append").option("path", path)
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
