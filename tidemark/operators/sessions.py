"""Session windows (T11) that do not funnel a key — or the whole table — into one task.

Spark's batch ``session_window`` sorts each key in one task, and without a key it
needs all rows in one partition. Here sessions come from one blocked pass:

* inside ``(key, block)``: ``lag(ts)`` marks a new session when the gap is exceeded;
* per block (small table): first/last timestamp and the number of internal starts;
  across blocks, the first row of a block starts a session iff it is more than
  ``gap`` after the previous block's last row; session ids are offsets plus local
  running starts;
* sessions are then aggregated with partial (map-side) aggregation, so a session
  that spans many blocks merges without meeting in one task.

Cost: one shuffle of the rows on ``(key, block)``, one narrow shuffle of
``(key, block, ts, tiebreak)`` for the block summaries (their in-block ``lag`` needs
order), a small block table that is kept, and the partial-aggregated session merge. Where no key
needs cutting, it is one window per key.

Semantics (the reference's): rows no more than ``gap`` apart share a session
(a gap of exactly ``gap`` still merges); a session is ``[first, last + gap)``. Rows
without a time are one session of their key, with neither start nor end; null keys are a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros, interval_us
from ..session import kept
from .blocks import FANOUT, measured_blocks
from .scan import NULL_BLOCK, Scan, null_safe_keys, scan

SID = "session_seq"


def session_ids(df: DataFrame, *, ts: str, gap_us: int, keys: list[str], block: Column | None,
                tiebreak: list[str] | None = None, fanout: int = 1024) -> DataFrame:
    """Adds ``session_seq`` (1-based per key) to every row. Without blocks (None) it is one window per key."""
    order = [F.col(ts), *[F.col(c) for c in (tiebreak or [])]]
    if block is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        prev, us = F.lag(epoch_micros(ts)).over(w), epoch_micros(ts)
        first = F.lag(F.lit(1)).over(w).isNull() | (prev.isNull() & us.isNotNull()) | ((us - prev) > gap_us)
        t = df.withColumn("_start", F.when(first, 1).otherwise(0))
        return t.withColumn(SID, F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_start")
    # internal (null-safe) key columns: null keys stay a group of their own
    t, keys = null_safe_keys(df.withColumn("_blk", F.coalesce(block, F.lit(NULL_BLOCK))).withColumn("_us", epoch_micros(ts)), keys, "_ss")
    w = Window.partitionBy(*keys, "_blk").orderBy(*order)
    prev = F.lag("_us").over(w)
    t = t.withColumn("_first", prev.isNull()) \
         .withColumn("_start", F.when(prev.isNotNull() & ((F.col("_us") - prev) > gap_us), 1).otherwise(0))
    t = t.withColumn("_lcum", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    # The block summary needs in-block order (lag), so it re-reads the rows: Catalyst
    # prunes this branch to (key, block, ts, tiebreak), a narrow second shuffle.
    blocks = t.groupBy(*keys, "_blk").agg(F.min("_us").alias("_bmin"), F.max("_us").alias("_bmax"),
                                          F.sum("_start").alias("_bint"))
    blocks = kept(blocks, "blocks")
    # Across blocks: scans over the block table, super-block by super-block.
    over = {"keys": keys, "order": ["_blk"], "block": F.floor(F.col("_blk") / fanout), "levels": 1, "fanout": fanout, "block_name": "_sblk"}
    blocks = scan(blocks, specs={"_bprev": Scan("max", F.col("_bmax"), inclusive=False)}, **over)
    later = F.col("_bmin").isNull() & (F.col("_blk") > NULL_BLOCK)  # rows without a time may be several blocks, and are one session
    blocks = blocks.withColumn("_bfirst", F.when(later, 0).when(F.col("_bprev").isNull() | ((F.col("_bmin") - F.col("_bprev")) > gap_us), 1).otherwise(0))
    blocks = scan(blocks, specs={"_boff": Scan("sum", F.col("_bfirst") + F.col("_bint"), inclusive=False)}, **over)
    blocks = blocks.withColumn("_boff", F.coalesce("_boff", F.lit(0)))
    out = t.join(blocks.select(*keys, "_blk", "_bfirst", "_boff"), on=[*keys, "_blk"], how="inner")
    out = out.withColumn(SID, (F.col("_boff") + F.col("_bfirst") + F.col("_lcum")).cast("long"))
    return out.drop("_blk", "_us", "_first", "_start", "_lcum", "_bfirst", "_boff", *keys)


def session_windows(df: DataFrame, *, ts: str, gap_us: int, keys: list[str], block: Column | None,
                    aggs: list[Column], tiebreak: list[str] | None = None,
                    columns: list[str] | None = None, fanout: int = 1024) -> DataFrame:
    """One row per session: keys, ``session_start``, ``session_end`` and ``aggs``.

    ``columns`` (default: all) are the input columns the ``aggs`` read; projecting
    to them first keeps the row shuffle narrow and shared by both branches.
    """
    if columns is not None:
        df = df.select(*dict.fromkeys([*keys, ts, *(tiebreak or []), *columns]))
    with_sid = session_ids(df, ts=ts, gap_us=gap_us, keys=keys, block=block, tiebreak=tiebreak, fanout=fanout)
    out = with_sid.groupBy(*keys, SID).agg(
        F.min(ts).alias("session_start"),
        (F.max(ts) + interval_us(gap_us)).alias("session_end"),
        *aggs)
    return out.drop(SID)


def merge_sessions(parts: DataFrame, *, gap_us: int, sums: list[str], keys: list[str] | None = None) -> DataFrame:
    """Sessions (keys, first, last, ``sums``) put together where the next of a key begins no more than ``gap_us`` after any before it has ended.

    Both the furthest end so far and the number of the session are scans over the parts, so the parts of a hot key never meet
    in one task. Parts without times are one session of their key; null keys are a key.
    """
    keys = keys or []
    rows, block = measured_blocks(parts.select(*keys, "first", "last", *sums), keys=keys, at="first")
    over = {"keys": keys, "order": ["first", "last"], "block": block, "fanout": FANOUT}
    s = scan(rows, specs={"_reach": Scan("max", epoch_micros("last"), inclusive=False)}, **over)
    at = epoch_micros("first")
    begins = at.isNotNull() & (F.col("_reach").isNull() | (at - F.col("_reach") > gap_us))
    s = scan(s.withColumn("_begins", F.when(begins, 1).otherwise(0)), specs={SID: Scan("sum", F.col("_begins"))}, **over)
    return s.groupBy(*keys, SID).agg(F.min("first").alias("first"), F.max("last").alias("last"), *[F.sum(c).cast("long").alias(c) for c in sums]).drop(SID)


def session_windows_builtin(df: DataFrame, *, ts: str, gap: str, keys: list[str],
                            aggs: list[Column]) -> DataFrame:
    """Spark's own ``session_window`` — the streaming form (needs a key column)."""
    out = df.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(*aggs)
    return out.select(*keys, F.col("w.start").alias("session_start"),
                      F.col("w.end").alias("session_end"), *[c for c in out.columns if c not in (*keys, "w")])
