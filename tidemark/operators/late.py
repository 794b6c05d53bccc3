"""Late data (T2, T4, T6, T7): per-arrival watermark replay over a batch.

A bounded-out-of-orderness watermark after a row has arrived is
``max(ts of rows arrived so far) - delay``. A row is dropped by an event-time
window operator when its window has already fired, i.e. when
``window_end <= watermark`` as of the rows that arrived *before* it (the
reference's boundary: fire when ``watermark >= end - 1 ms`` with a watermark of
``max - delay - 1 ms``).

Structured Streaming applies the previous micro-batch's watermark, so it keeps
some rows this replay drops; the replay gives the exact per-arrival answer and is
what the oracle checks. The running maximum is a blocked scan over arrival order.

A generator that emits periodically moves the watermark only at ticks: between two ticks the rows meet the
maximum as of the last one. That needs no order inside a tick, only a scan over one maximum a tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros, ntz_from_micros
from .scan import NULL_BLOCK, Scan, id_block, null_safe_equal, scan


def with_watermark_replay(df: DataFrame, *, ts: str, arrival: list[Column], block: Column,
                          window_us: int, delay_us: int) -> DataFrame:
    """Adds ``window_start``, ``window_end``, ``watermark`` (before this row) and ``is_late``."""
    s = scan(df, keys=[], order=arrival, block=block,
             specs={"_maxprev": Scan("max", epoch_micros(ts), inclusive=False)})
    us = epoch_micros(ts)
    wstart = F.floor(us / window_us).cast("long") * window_us
    wm = F.col("_maxprev") - F.lit(delay_us)
    return (s.withColumn("window_start", ntz_from_micros(wstart))
             .withColumn("window_end", ntz_from_micros(wstart + window_us))
             .withColumn("watermark", ntz_from_micros(wm))
             .withColumn("is_late", F.coalesce((wstart + window_us) <= wm, F.lit(False)))
             .drop("_maxprev"))


def late_events(df: DataFrame, **kw) -> DataFrame:
    """Rows a watermarked tumbling-window operator would drop."""
    return with_watermark_replay(df, **kw).filter("is_late")


def on_time_window_counts(df: DataFrame, **kw) -> DataFrame:
    """Window counts after late rows are dropped (what the windowed operator emits)."""
    r = with_watermark_replay(df, **kw).filter(~F.col("is_late"))
    return r.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("events"))


#: Ticks of a block of the scan over ticks.
TICKS = 4096


def with_periodic_watermark(df: DataFrame, *, ts: str, tick: Column, window_us: int, delay_us: int) -> DataFrame:
    """T4/T5: adds ``window_start``, ``window_end``, ``watermark`` and ``is_late`` where the watermark is emitted at ticks only.

    ``tick`` numbers the period in which a row arrives (arrival clock over emission interval); a row meets the latest time of all
    rows of earlier ticks, less the delay. Each tick leaves the map side as its maximum, those are scanned in
    blocks, and rows find their tick's watermark by an equi-join. Rows without a tick come before all ticks, rows without a time are never late.
    """
    us = epoch_micros(ts)
    rows = df.withColumn("_tick", F.coalesce(tick.cast("long"), F.lit(NULL_BLOCK)))
    ticks = rows.groupBy(F.col("_tick").alias("_t")).agg(F.max(us).alias("_max"))
    ticks = scan(ticks, keys=[], order=["_t"], block=id_block("_t", TICKS), specs={"_seen": Scan("max", F.col("_max"), inclusive=False)})
    out = rows.join(ticks.select("_t", "_seen"), null_safe_equal([F.col("_tick")], [F.col("_t")]), "left")
    wstart = F.floor(us / window_us).cast("long") * window_us
    wm = F.col("_seen") - F.lit(delay_us)
    return (out.withColumn("window_start", ntz_from_micros(wstart)).withColumn("window_end", ntz_from_micros(wstart + window_us))
               .withColumn("watermark", ntz_from_micros(wm)).withColumn("is_late", F.coalesce((wstart + window_us) <= wm, F.lit(False)))
               .drop("_tick", "_t", "_seen"))
