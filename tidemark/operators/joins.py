"""Multi-stream operators (J1-J5): union, window join, interval join, connect, as-of join.

* Window and interval joins are equi-joins on ``(key, time bucket)`` plus a range
  residual, so a hot key is spread over its time buckets instead of meeting in one
  join partition; AQE's skew-join splitting covers a hot ``(key, bucket)``.
* The connected-streams running ratio is a blocked scan (no single task).
* The as-of (broadcast-state) join turns a control side of few rows into intervals;
  otherwise it runs as a blocked "last value" scan over the union of both sides. Both give one answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros, floor_time
from .blocks import FANOUT, measured_blocks
from .scan import Scan, null_safe_equal, scan


def union_streams(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates are kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def window_join(left: DataFrame, right: DataFrame, *, key: str, left_ts: str, right_ts: str,
                size_us: int) -> DataFrame:
    """Every (left, right) pair with the same key inside the same tumbling window.

    ``left``/``right`` must have disjoint column names except ``key``. Output keeps
    both sides' columns plus ``window_start``/``window_end``.
    """
    lw = left.withColumn("window_start", floor_time(left_ts, size_us))
    rw = right.withColumn("window_start", floor_time(right_ts, size_us))
    out = lw.join(rw, on=[key, "window_start"], how="inner")
    return out.withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {size_us} MICROSECONDS"))


def interval_join(left: DataFrame, right: DataFrame, *, key: str, left_ts: str, right_ts: str,
                  lower_us: int, upper_us: int, lower_inclusive: bool = True,
                  upper_inclusive: bool = True, bucket_us: int | None = None) -> DataFrame:
    """Pairs with ``left_ts + lower (<|<=) right_ts (<|<=) left_ts + upper`` per key.

    Each left row looks at the one or two right-side time buckets its interval
    touches (bucket width >= interval length), so every pair is found exactly once.
    ``left``/``right`` must have disjoint column names except ``key``.
    """
    width = bucket_us or max(upper_us - lower_us, 1)
    lus = epoch_micros(left_ts)
    cand = F.sequence(F.floor((lus + lower_us) / width).cast("long"),
                      F.floor((lus + upper_us) / width).cast("long"))
    lb = left.withColumn("_bucket", F.explode(cand))
    rb = right.withColumn("_bucket", F.floor(epoch_micros(right_ts) / width).cast("long"))
    delta = epoch_micros(F.col(right_ts)) - epoch_micros(F.col(left_ts))
    lo = delta >= lower_us if lower_inclusive else delta > lower_us
    hi = delta <= upper_us if upper_inclusive else delta < upper_us
    return lb.join(rb, on=[key, "_bucket"], how="inner").filter(lo & hi).drop("_bucket")


def connect(first: DataFrame, second: DataFrame, *, ts: str, order_id: str) -> DataFrame:
    """J4 ``connect``: both streams as (event_id, ts, source), source 0 = first. Where both are filters of
    one table, tag its rows instead: then it is read once."""
    return union_streams(
        first.select(F.col(order_id).alias("event_id"), F.col(ts).alias("ts"), F.lit(0).alias("source")),
        second.select(F.col(order_id).alias("event_id"), F.col(ts).alias("ts"), F.lit(1).alias("source")))


def running_ratio(tagged: DataFrame, *, block_rows: int | None = None, name: str = "ratio") -> DataFrame:
    """J4 co-process: after every arrival from either stream, emit
    ``count(first) * 100.0 / (count(first) + count(second))`` so far.

    ``tagged`` is what ``connect`` gives. Arrival order is ``(ts, source, event_id)``. Counts are a
    blocked global scan, not a parallelism-1 operator.
    """
    # what orders rows at one time, source and then id, as one whole number, for the cut of rows that have no time or the same
    ends = tagged.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    room = 0 if ends["lo"] is None else ends["hi"] - ends["lo"] + 2
    tie = F.col("source") * F.lit(room) + F.coalesce(F.col("event_id") - F.lit(ends["lo"]) + 1, F.lit(0))
    rows, block = measured_blocks(tagged.withColumn("_tie", tie.cast("long")), keys=[], at="ts", tie="_tie", rows=block_rows)
    s = scan(rows.drop("_tie"), keys=[], order=["ts", "source", "event_id"], block=block, fanout=FANOUT,
             specs={"first_count": Scan("sum", (F.col("source") == 0).cast("long")),
                    "second_count": Scan("sum", (F.col("source") == 1).cast("long"))})
    return s.withColumn(name, F.round(F.col("first_count") * 100.0 /
                                      (F.col("first_count") + F.col("second_count")), 6))


def _control(right: DataFrame, right_ts: str, by: list[str], values: list[str], right_order: list[str]) -> DataFrame:
    """One control row per key and time, the last by ``right_order`` and then by its values; none without a time."""
    last = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(right_order)], F.struct(*values).alias("_payload"))
    rows = right.filter(F.col(right_ts).isNotNull()).select(*[F.col(k).alias(f"_rk{i}") for i, k in enumerate(by)],
                                                           F.col(right_ts).alias("_from"), last.alias("_last"))
    keys = [f"_rk{i}" for i in range(len(by))]
    return rows.groupBy(*keys, "_from").agg(F.max("_last").getField("_payload").alias("_payload"))


def asof_join(left: DataFrame, right: DataFrame, *, left_ts: str, right_ts: str,
              values: list[str], by: list[str] | None = None, right_order: list[str] | None = None, strategy: str = "auto",
              max_broadcast_rows: int = 10_000, max_loop_rows: int = 64, block_rows: int | None = None) -> DataFrame:
    """Each left row gets the latest right row with ``right_ts <= left_ts``
    (same ``by`` key); left rows before any control row, or without a time, get nulls.

    Every left row stays. A null key matches a null key. Control rows without a time are never in
    force; of several at one key and time the last by ``right_order``, then by its values, is. The
    strategy picks a plan and never changes the answer:

      ``broadcast`` — control rows become intervals ``[ts, next_ts)``, joined by key and range (without
                      ``by``, a loop over the control rows: keep them few, as in a literal table).
      ``scan``      — union both sides, blocked "last value" scan; no size limit.
      ``auto``      — counts right rows up to a bound and takes intervals only within it:
                      ``max_broadcast_rows``, or ``max_loop_rows`` without ``by``.
    """
    by, keys = by or [], [f"_rk{i}" for i in range(len(by or []))]
    control = _control(right, right_ts, by, values, right_order or [])
    if strategy == "auto":
        bound = max_broadcast_rows if by else max_loop_rows
        strategy = "broadcast" if right.limit(bound + 1).count() <= bound else "scan"
    outputs = [F.col("_payload").getField(v).alias(v) for v in values]
    kept = [F.col(c) for c in left.columns]
    if strategy == "broadcast":
        w = Window.partitionBy(*keys).orderBy("_from") if keys else Window.orderBy("_from")
        intervals = control.withColumn("_to", F.lead("_from").over(w))
        at = F.col(left_ts)
        cond = null_safe_equal([F.col(k) for k in by], [F.col(k) for k in keys])
        cond = cond & (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
        return left.join(intervals, cond, "left").select(*kept, *outputs)
    if strategy != "scan":
        raise ValueError(f"unknown strategy {strategy!r}")
    lt = left.select("*", *[F.col(k).alias(r) for k, r in zip(by, keys, strict=True)], F.col(left_ts).alias("_at"), F.lit(1).alias("_side"),
                     F.lit(None).cast(control.schema["_payload"].dataType).alias("_payload"))
    rt = control.select(*keys, F.col("_from").alias("_at"), F.lit(0).alias("_side"), "_payload")
    both = lt.unionByName(rt, allowMissingColumns=True)
    both, block = measured_blocks(both, keys=keys, at="_at", rows=block_rows)
    s = scan(both, keys=keys, order=["_at", "_side"], block=block, fanout=FANOUT, specs={"_cur": Scan("last", F.col("_payload"))})
    s = s.filter(F.col("_side") == 1)
    return s.select(*kept, *[F.col("_cur").getField(v).alias(v) for v in values])
