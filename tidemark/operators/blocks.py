"""Blocks of an ordered scan from what the data hold, not from a clock.

A scan (``scan.py``) cuts the order of each key into blocks that a task can hold. How wide a block
must be depends on the key: one aggregate over keys and positions gives each key's rows and
span. Keys of up to ``target_rows`` rows are one block. For the others the width is that of
``target_rows`` evenly spread rows, and blocks that turn out over-full (a burst) are cut
again by their own counts. Rows at one position, and rows without one, can't be told apart by it: where more than a block's
worth of them meet, they are cut by what orders them next. If no key needs cutting there are no blocks at all, and the
scan is one window per key. The cut never changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros
from ..session import kept
from .scan import NULL_BLOCK, null_safe_equal

BLOCK_COLUMN = "_ablk"

#: A block's number has three parts: the first cut, the second cut of an over-full block, and the cut of rows at one position.
FIRST, SECOND, THIRD = 1 << 24, 1 << 20, 1 << 18

#: ``fanout`` of a scan over these blocks: super-blocks of 1024 of the first cut.
FANOUT = 1024 * SECOND * THIRD

DEFAULT_ROWS = 1_000_000


def target_rows(spark) -> int:
    """Rows of a block: ``spark.tidemark.scan.blockRows``."""
    return int(spark.conf.get("spark.tidemark.scan.blockRows", str(DEFAULT_ROWS)))


#: Keys that need cutting (at most rows / target_rows): so few go through the driver, more are kept as a table, and broadcast up to this number.
DRIVER_KEYS, BROADCAST_KEYS = 1000, 100_000


def _upto(n: int, c: Column) -> Column:
    """Block numbers stay in their room: what would leave it shares the last one."""
    return F.when(c.isNotNull(), F.least(F.lit(n - 1), c)).cast("long")


def _width(lo: str, hi: str, n: str, rows: int) -> Column:
    """The width of ``rows`` of ``n`` evenly spread rows between ``lo`` and ``hi``."""
    return F.greatest(F.lit(1), F.ceil((F.col(hi) - F.col(lo) + 1) * F.lit(float(rows)) / F.col(n))).cast("long")


def measured_blocks(df: DataFrame, *, keys: list[str], at: str | Column, tie: str | None = None, rows: int | None = None) -> tuple[DataFrame, Column | None]:
    """``df`` with a block column, and that column; or ``df`` and None if no key has more than ``rows`` rows.

    ``at`` is the first order column: a timestamp's name, or a whole-number Column; ``tie`` names the second, a whole number.
    Null keys are a key. Without ``tie`` rows at one position share a block. The tables kept in the shared folder
    hold one row per key of more than ``rows`` rows (if those are many), per over-full block, and per position with more than four times ``rows``.
    """
    rows = rows or target_rows(df.sparkSession)
    position = epoch_micros(at) if isinstance(at, str) else at.cast("long")
    names = [f"_b_{k}" for k in keys]

    def as_keys(suffix: str = "") -> list[Column]:
        return [F.col(k).alias(n + suffix) for k, n in zip(keys, names, strict=True)]

    def same(suffix: str = "") -> Column:
        return null_safe_equal([F.col(k) for k in keys], [F.col(n + suffix) for n in names])

    stats = df.groupBy(*as_keys()).agg(F.count(F.lit(1)).alias("_n"), F.min(position).alias("_lo"), F.max(position).alias("_hi"))
    hot = stats.filter(F.col("_n") > rows).select(*names, "_lo", _width("_lo", "_hi", "_n", rows).alias("_width"))
    known = hot.limit(DRIVER_KEYS + 1).collect()
    if not known:
        return df, None
    columns = df.columns
    if keys:
        if len(known) <= DRIVER_KEYS:
            few = F.broadcast(df.sparkSession.createDataFrame(known, hot.schema))
        else:
            hot = kept(hot, "hot")
            few = F.broadcast(hot) if hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else hot
        cut = df.join(few, same(), "left").drop(*names)
    else:
        whole = known[0]
        cut = df.withColumns({"_lo": F.lit(whole["_lo"]).cast("long"), "_width": F.lit(whole["_width"]).cast("long")})
    cut = cut.withColumn("_first", _upto(FIRST, F.floor((position - F.col("_lo")) / F.col("_width")))).withColumn("_second", F.lit(0).cast("long"))
    counts = cut.filter("_first IS NOT NULL").groupBy(*as_keys("2"), F.col("_first").alias("_f")).agg(F.count(F.lit(1)).alias("_c"))
    full = kept(counts.filter(F.col("_c") > 4 * rows), "full")
    if not full.isEmpty():
        cut = cut.join(full, same("2") & (F.col("_first") == F.col("_f")), "left").drop(*[f"{n}2" for n in names])
        narrow = F.greatest(F.lit(1), F.ceil(F.col("_width") * F.lit(float(rows)) / F.col("_c")))
        second = _upto(SECOND, F.floor((position - F.col("_lo") - F.col("_first") * F.col("_width")) / narrow))
        cut = cut.withColumn("_second", F.coalesce(second, F.lit(0)))
    third, bare = F.lit(0).cast("long"), F.lit(None).cast("long")
    if tie is not None:
        order = F.col(tie).cast("long")
        measure = [F.count(F.lit(1)).alias("_tn"), F.min(order).alias("_tlo"), F.max(order).alias("_thi")]
        share = F.coalesce(F.floor((order - F.col("_tlo")) / _width("_tlo", "_thi", "_tn", rows)), F.lit(0))
        if not full.isEmpty():  # positions with many rows: those before, at and after them are told apart
            places = cut.filter("_f IS NOT NULL").groupBy(*as_keys("3"), F.col("_first").alias("_g"), F.col("_second").alias("_h"), position.alias("_p")).agg(*measure)
            heavy = places.filter(F.col("_tn") > 4 * rows).groupBy(*[f"{n}3" for n in names], "_g", "_h").agg(F.max_by(F.struct("_p", "_tn", "_tlo", "_thi"), F.struct("_tn", "_p")).alias("_m"))
            heavy = kept(heavy.select(*[f"{n}3" for n in names], "_g", "_h", "_m.*"), "heavy")
            if not heavy.isEmpty():
                cut = cut.join(heavy, same("3") & (F.col("_first") == F.col("_g")) & (F.col("_second") == F.col("_h")), "left").drop(*[f"{n}3" for n in names])
                inside = F.when(position < F.col("_p"), F.lit(0)).when(position > F.col("_p"), F.lit(THIRD - 1)).otherwise(F.least(F.lit(THIRD - 2), share + 1))
                cut = cut.withColumn("_third", F.coalesce(inside, F.lit(0)).cast("long")).drop("_g", "_h", "_p", "_tn", "_tlo", "_thi")
                third = F.col("_third")
        none = kept(df.filter(position.isNull()).groupBy(*as_keys("4")).agg(*measure).filter(F.col("_tn") > rows), "timeless")
        if not none.isEmpty():
            cut = cut.join(none, same("4") & position.isNull(), "left").drop(*[f"{n}4" for n in names])
            bare = F.lit(NULL_BLOCK) + _upto(THIRD, share)
    number = (F.col("_first") * SECOND + F.col("_second")) * THIRD + third
    block = F.when(position.isNull(), bare).when(F.col("_width").isNull(), F.lit(0)).otherwise(number).cast("long")
    return cut.select(*columns, block.alias(BLOCK_COLUMN)), F.col(BLOCK_COLUMN)
