"""Stream-stream joins that spread a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros

BUCKET = "_bucket"


def interval_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str, left_ts: str, right_ts: str, span_us: int, within: str) -> DataFrame:
    """J3 over two streams with watermarks: pairs of one key for which ``within``, a condition on both times, holds.

    Both sides are keyed by (key, time bucket), so the state of a hot key is spread over its buckets, as in the batch form:
    a right row is kept in the bucket of its time, a left row in the one or two buckets that times up to ``span_us`` away from
    its own can lie in. Each right row has one bucket, so no pair is found twice. ``within`` must imply that the times are
    no more than ``span_us`` apart; written with time intervals, as ``b > a - INTERVAL 2 HOURS``, it lets Spark drop the
    rows, and with them the buckets, that the other side's watermark has left behind.
    """
    width = 2 * span_us
    at = epoch_micros(left_ts)
    near = F.sequence(F.floor((at - span_us) / width).cast("long"), F.floor((at + span_us) / width).cast("long"))
    lb = left.withColumn(BUCKET, F.explode(near))
    rb = right.withColumn(f"{BUCKET}_r", F.floor(epoch_micros(right_ts) / width).cast("long"))
    return lb.join(rb, F.expr(f"{left_key} = {right_key} AND {BUCKET} = {BUCKET}_r AND {within}"), "inner").drop(BUCKET, f"{BUCKET}_r")
