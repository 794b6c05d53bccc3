"""Per-key running state in batch (A1, V2-V5, V7) and count triggers.

``block``, ``levels`` and ``fanout`` are the scan's (``scan.py``, ``blocks.py``).

The reference keeps Value/List/Map state per key and emits after every element.
In batch the same outputs are ordered prefix computations, one output row per
input row, computed with the blocked scan (``scan.py``) so a hot key never sits
in one task. Streaming twins with real ``transformWithState`` processors live in
``tidemark.streaming.processors``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_micros, sorted_map_string
from .scan import NULL_BLOCK, Scan, null_safe_keys, scan


EXACT = "decimal(38,0)"  # sums of 64-bit numbers leave 64 bits after some 10**9 rows


def rolling_reduce(df: DataFrame, *, key: str | Column, value: str, order: list[str], block: Column | None, levels: int = 1, fanout: int = 1024,
                   name: str = "running_sum", key_name: str = "key") -> DataFrame:
    """A1 ``keyed.reduce(_ + _)`` over whole numbers: the running sum per key after every element, exact."""
    k = F.col(key) if isinstance(key, str) else key
    d = df.withColumn(key_name, k)
    out = scan(d, keys=[key_name], order=order, block=block, specs={name: Scan("sum", F.col(value).cast("decimal(20,0)"))}, levels=levels, fanout=fanout)
    return out.withColumn(name, F.col(name).cast(EXACT))


def reduce_final(df: DataFrame, *, key: str | Column, value: str, name: str = "total",
                 key_name: str = "key") -> DataFrame:
    """A1 final values: a grouped sum (partial + final aggregation), exact."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias(key_name)).agg(F.sum(F.col(value).cast("decimal(20,0)")).cast(EXACT).alias(name))


def running_count(df: DataFrame, *, key: str, order: list[str], block: Column | None, levels: int = 1, fanout: int = 1024, name: str = "n") -> DataFrame:
    """V2 ValueState counter: events so far for this key, including the current one."""
    return scan(df, keys=[key], order=order, block=block, specs={name: Scan("count")}, levels=levels, fanout=fanout)


def running_type_counts(df: DataFrame, *, key: str, type_col: str, order: list[str],
                        block: Column | None, levels: int = 1, fanout: int = 1024, name: str = "counts", as_text: bool = True) -> DataFrame:
    """V4 MapState: per key, the count of each type seen so far, rendered as
    ``type=n, ...`` sorted by type, or as a map; types never seen omitted (a null type is none).

    No list of types is needed: inside a block a row meets the types of its block; the counts
    of the blocks before it come from a scan over (key, type) totals. Work and
    output grow with rows times the types of their key.
    """
    p, uncut, shown = "_tc", block is None, sorted_map_string if as_text else (lambda m: m)
    columns = F.struct(*df.columns)
    d, keys = null_safe_keys(df.withColumn(p, F.lit(0) if uncut else F.coalesce(block, F.lit(NULL_BLOCK))), [key], p)
    in_block = Window.partitionBy(*keys, p)
    rows = d.select(*keys, p, columns.alias("_row"), F.col(type_col).alias("_own"), F.collect_set(type_col).over(in_block).alias("_types"),
                    F.row_number().over(in_block.orderBy(*order)).alias("_i"))
    met = rows.select(*keys, p, "_row", "_i", "_own", F.explode_outer("_types").alias("_type"))
    so_far = Window.partitionBy(*keys, p, "_type").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = met.withColumn("_n", F.count_if(F.col("_own") == F.col("_type")).over(so_far))
    entry = F.when(F.col("_n") > 0, F.struct("_type", "_n"))
    local = met.groupBy(*keys, p, "_i").agg(F.first("_row").alias("_row"), F.map_from_entries(F.collect_list(entry)).alias("_here"))

    if uncut:
        return local.select("_row.*", shown(F.col("_here")).alias(name))
    # totals of (key, block, type); every block of a key gets every type of the key
    totals = d.filter(F.col(type_col).isNotNull()).groupBy(*keys, p, F.col(type_col).alias("_type")).agg(F.count(F.lit(1)).alias("_n"))
    cells = d.select(*keys, p).distinct().join(totals.select(*keys, "_type").distinct(), keys).join(totals, [*keys, p, "_type"], "left")
    before = scan(cells, keys=[*keys, "_type"], order=[p], block=F.floor(F.col(p) / fanout).cast("long"),
                  specs={"_before": Scan("sum", F.coalesce("_n", F.lit(0)), inclusive=False)}, levels=max(levels - 1, 0), fanout=fanout, block_name=p + "s")
    earlier = F.when(F.col("_before") > 0, F.struct("_type", "_before"))
    before = before.groupBy(*keys, p).agg(F.map_from_entries(F.collect_list(earlier)).alias("_earlier"))
    out = local.join(before, [*keys, p], "left")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    both = F.map_zip_with("_here", F.coalesce("_earlier", none), lambda k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    return out.select("_row.*", shown(both).alias(name))


def open_lists(df: DataFrame, *, key: str, order: list[str], block: Column | None, levels: int = 1, fanout: int = 1024, item: Column,
               clear_above: int, ttl_us: int | None = None, ts: str | None = None) -> DataFrame:
    """``df`` with ``_rn``, the row's number in its key, and ``_list``, the items of the key's list after this row.

    A list of more than ``clear_above`` items is cleared after it was read, so sizes cycle
    ``1 .. clear_above + 1``. With ``ttl_us`` a list that was not written for so long or longer is
    gone when the next element comes. Two causes end a list, but only one of them looks at time, and that one looks
    at the row before, not at the list: a first scan gives each row's number and the time ``ts`` before it, so
    it is known where lists expire; a second gives the number of the last row at which one did, and cycles
    count from there. A list is gathered from the rows of its own cycle, ``clear_above + 1`` at most, so no group is unbounded.
    """
    over = {"keys": [key], "order": order, "block": block, "levels": levels, "fanout": fanout}
    if ttl_us is None:
        s, life = scan(df, specs={"_rn": Scan("count")}, **over), F.lit(1)
    else:
        s = scan(df, specs={"_rn": Scan("count"), "_before": Scan("max", epoch_micros(ts), inclusive=False)}, **over)
        begins = (F.col("_rn") == 1) | (epoch_micros(ts) - F.col("_before") >= ttl_us)
        s = scan(s.withColumn("_begin", F.when(begins, F.col("_rn"))), specs={"_life": Scan("max", F.col("_begin"))}, **over)
        s, life = s.drop("_before", "_begin"), F.col("_life")
    s = s.withColumn("_first", F.col("_rn") - F.pmod(F.col("_rn") - life, F.lit(clear_above + 1)))  # the list's first row
    w = Window.partitionBy(key, "_first").orderBy("_rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return s.withColumn("_list", F.collect_list(item).over(w)).drop("_life", "_first")


def recent_list(df: DataFrame, *, key: str, order: list[str], block: Column | None, levels: int = 1, fanout: int = 1024, item: Column,
                clear_above: int = 10, name: str = "items") -> DataFrame:
    """V5 ListState with clearing: append, read, clear when the list has more than
    ``clear_above`` elements (``open_lists``)."""
    s = open_lists(df, key=key, order=order, block=block, levels=levels, fanout=fanout, item=item, clear_above=clear_above)
    return s.withColumn("list_size", F.size("_list")).withColumn(name, F.array_join("_list", ", ")).drop("_rn", "_list")


def recent_list_ttl(df: DataFrame, *, key: str, ts: str, order: list[str], block: Column | None, levels: int = 1, fanout: int = 1024, item: Column,
                    ttl_us: int, clear_above: int = 10, name: str = "items") -> DataFrame:
    """V5 ListState with clearing and time to live in event time (``open_lists``); ``ts`` is the first of ``order``.

    Rows without a time come first in their key; they neither expire nor let expire.
    """
    s = open_lists(df, key=key, order=order, block=block, levels=levels, fanout=fanout, item=item, clear_above=clear_above, ttl_us=ttl_us, ts=ts)
    return s.withColumn("list_size", F.size("_list")).withColumn(name, F.array_join("_list", ", ")).drop("_rn", "_list")


def global_count_trigger(df: DataFrame, *, every: int, order: list[str], block: Column | None, levels: int = 1, fanout: int = 1024,
                         measure: Column, name: str = "measure") -> DataFrame:
    """T12 global window + CountTrigger(every): fires after every ``every``-th
    element with the aggregate over *all* elements so far (non-purging). Trailing
    elements that never complete a group never fire."""
    s = scan(df, keys=[], order=order, block=block,
             specs={"seen": Scan("count"), name: Scan("sum", measure.cast("long"))}, levels=levels, fanout=fanout)
    return s.filter(F.col("seen") % every == 0).select("seen", name)


def window_count_trigger(df: DataFrame, *, window_start: str, window_end: str, every: int,
                         order: list[str], block: Column | None, levels: int = 1, fanout: int = 1024, purging: bool = False) -> DataFrame:
    """CountTrigger(every) on a time window.

    Fires at the every-th, 2*every-th ... element of each window; the pane size is
    cumulative (``rn``), or ``every`` for the purging variant (the window is
    cleared after each firing). The remainder below ``every`` never fires.
    """
    s = scan(df, keys=[window_start, window_end], order=order, block=block, specs={"_rn": Scan("count")},
             levels=levels, fanout=fanout)
    fired = s.filter(F.col("_rn") % every == 0)
    return fired.select(window_start, window_end,
                        (F.col("_rn") / every).cast("long").alias("firing"),
                        (F.lit(every).cast("long") if purging else F.col("_rn")).alias("pane_size"))
