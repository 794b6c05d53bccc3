"""Skew-safe ordered scans (running sums / maxima / last values) over keyed or global order.

Every "state that depends on arrival order" in the reference — running counts per
user, rolling reduce, count triggers, global windows, the co-process running ratio,
watermark replay, session boundaries, as-of lookups — is a prefix scan. Written as a
plain ``Window.partitionBy(key).orderBy(ts)`` it sends each key (or, without a key,
the whole table) to a single task: a key holding a third of the rows becomes a
third of the job in one task.

Instead the order of a key that is too large for a task is cut into *blocks* (a monotone function of
the order, see ``blocks.py``) and the scan is done in two levels:

1. local running value inside ``(key, block)`` — one shuffle, balanced because a hot
   key is spread over many blocks;
2. block totals via ``groupBy(key, block)`` — partial (map-side) aggregation, so only
   one row per block leaves each task, kept as a small table that is computed once — and an
   exclusive running total over blocks, computed by the same blocked scan over super-blocks of ``fanout`` blocks, so no
   task orders more than ``#blocks / fanout`` block rows of one key;
3. join back on ``(key, block)``: the big side is already hash-partitioned on exactly
   those columns by step 1, so it is not shuffled again; AQE broadcasts the small
   side when its measured size allows.

Results are exact: nothing is sampled or capped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_micros
from ..session import kept

BLOCK = "_blk"

#: The block of rows whose order column is null: they sort first, as nulls do.
NULL_BLOCK = -(1 << 62)


@dataclass(frozen=True)
class Scan:
    """One running value: ``kind`` in sum | count | max | min | last.

    ``value`` is the per-row input (ignored for count). ``inclusive`` selects the
    frame: rows up to and including the current one, or strictly before it.
    ``last`` is the most recent non-null ``value`` in scan order.
    """
    kind: str
    value: Column | None = None
    inclusive: bool = True


def time_block(ts: str | Column, width_us: int) -> Column:
    """Block id from a timestamp: ``floor(epoch_us / width)``; monotone in time."""
    return F.floor(epoch_micros(ts) / F.lit(width_us)).cast("long")


def id_block(c: str | Column, width: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c / F.lit(width)).cast("long")


def null_safe_equal(left: list[Column], right: list[Column]) -> Column:
    """Keys are equal, and a null key equals a null key."""
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & a.eqNullSafe(b)
    return cond


def _zero(dtype: T.DataType) -> Column:
    """Any fixed value of ``dtype`` (stands in for null next to the isnull flag)."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    raise ValueError(f"scan keys must be atomic columns, got {dtype.simpleString()}: flatten them first")


def null_safe_keys(df: DataFrame, keys: list[str], prefix: str) -> tuple[DataFrame, list[str]]:
    """Replace each key by ``(isnull(k), coalesce(k, default))`` helper columns.

    Windows group null keys together, but an equi-join drops them; joining (and
    partitioning) on the helper pair keeps null-key rows as their own group
    without re-shuffling, since both sides use the same expressions.
    """
    cols = []
    for i, k in enumerate(keys):
        n, v = f"{prefix}_kn{i}", f"{prefix}_kv{i}"
        df = df.withColumn(n, F.col(k).isNull()).withColumn(v, F.coalesce(F.col(k), _zero(df.schema[k].dataType)))
        cols += [n, v]
    return df, cols


def _order_struct(order: list[Column], value: Column) -> Column:
    fields = [o.alias(f"o{i}") for i, o in enumerate(order)]
    return F.when(value.isNotNull(), F.struct(*fields, value.alias("v")))


def _windowed(df: DataFrame, keys: list[str], order: list[Column], specs: dict[str, Scan]) -> DataFrame:
    """The running values by one window per key."""
    out = []
    for name, sp in specs.items():
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow if sp.inclusive else -1)
        if sp.kind == "count":
            out.append(F.count(F.lit(1)).over(w).alias(name))
        elif sp.kind == "last":
            out.append(F.last(sp.value, ignorenulls=True).over(w).alias(name))
        else:
            out.append({"sum": F.sum, "min": F.min, "max": F.max}[sp.kind](sp.value).over(w).alias(name))
    return df.select(*[c for c in df.columns if c not in specs], *out)


def scan(df: DataFrame, *, keys: list[str], order: list[str | Column], block: Column | None,
         specs: dict[str, Scan], levels: int = 1, fanout: int = 1024, block_name: str = BLOCK) -> DataFrame:
    """Add one column per ``specs`` entry holding the running value in ``order``
    within each ``keys`` group. ``block`` must be monotone (non-decreasing) in
    ``order`` within a key; None (no key needs cutting, see ``blocks.py``) makes it one window per key. Null keys are a group of their own; rows whose block is null
    (their first order column is) come first in their group, as nulls sort.

    The exclusive prefix over the block table is itself a blocked scan over
    super-blocks of ``fanout`` blocks (``levels`` deep), so even a key-less scan
    over billions of rows never orders more than ``#blocks / fanout`` rows in one
    task.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if any(sp.kind not in ("sum", "count", "min", "max", "last") for sp in specs.values()):
        raise ValueError(f"unknown scan kind in {sorted(sp.kind for sp in specs.values())}")
    if block is None:
        return _windowed(df, keys, order, specs)
    p = block_name  # prefix for this level's internal columns
    # internal (null-safe) key columns: null keys stay a group of their own
    tmp, keys = null_safe_keys(df.withColumn(p, F.coalesce(block, F.lit(NULL_BLOCK))), keys, p)
    local_cols, total_cols, internal = [], [], list(keys)
    for name, sp in specs.items():
        if sp.kind == "count":
            v, agg = F.lit(1).cast("long"), F.sum
        elif sp.kind == "sum":
            v, agg = sp.value, F.sum
        elif sp.kind == "max":
            v, agg = sp.value, F.max
        elif sp.kind == "min":
            v, agg = sp.value, F.min
        else:  # last
            v, agg = _order_struct(order, sp.value), F.max
        vname, lname, tname, oname = (f"{p}_v_{name}", f"{p}_l_{name}", f"{p}_t_{name}", f"{p}_o_{name}")
        internal += [vname, lname, oname]
        tmp = tmp.withColumn(vname, v)
        frame_end = Window.currentRow if sp.inclusive else -1
        w_local = (Window.partitionBy(*keys, p).orderBy(*order)
                   .rowsBetween(Window.unboundedPreceding, frame_end))
        local_cols.append(agg(vname).over(w_local).alias(lname))
        total_cols.append(agg(vname).alias(tname))

    local = tmp.select("*", *local_cols)
    totals = kept(tmp.groupBy(*keys, p).agg(*total_cols), "totals")
    offsets = _block_offsets(totals, keys, p, specs, levels, fanout)
    out = local.join(offsets, on=[*keys, p], how="inner")
    for name, sp in specs.items():
        loc, off = F.col(f"{p}_l_{name}"), F.col(f"{p}_o_{name}")
        if sp.kind in ("sum", "count"):
            val = F.coalesce(off, F.lit(0)) + F.coalesce(loc, F.lit(0))
            if sp.kind == "sum":
                val = F.when(off.isNull() & loc.isNull(), F.lit(None)).otherwise(val)  # like SQL's sum
        elif sp.kind == "min":
            val = F.least(off, loc)
        elif sp.kind == "max":
            val = F.greatest(off, loc)
        else:  # last
            val = F.greatest(off, loc)["v"]
        out = out.withColumn(name, val)
    return out.drop(*internal, p)


def _merge_kind(kind: str) -> str:
    return {"count": "sum", "sum": "sum", "min": "min", "max": "max", "last": "max"}[kind]


def _block_offsets(totals: DataFrame, keys: list[str], p: str, specs: dict[str, Scan],
                   levels: int, fanout: int) -> DataFrame:
    """Exclusive prefix of the block totals over blocks, per key: ``{p}_o_{name}``."""
    if levels > 0:
        sub = {f"{p}_o_{n}": Scan(_merge_kind(sp.kind), F.col(f"{p}_t_{n}"), inclusive=False)
               for n, sp in specs.items()}
        res = scan(totals, keys=keys, order=[p], block=F.floor(F.col(p) / F.lit(fanout)).cast("long"),
                   specs=sub, levels=levels - 1, fanout=fanout, block_name=p + "s")
        return res.select(*keys, p, *sub)
    # Last level: one window per key over its (super-)blocks. Without keys this is
    # the only place rows meet in one task, and it holds #blocks / fanout**levels rows.
    w = (Window.partitionBy(*keys).orderBy(p) if keys else Window.orderBy(p)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    fn = {"sum": F.sum, "min": F.min, "max": F.max}
    return totals.select(*keys, p, *[fn[_merge_kind(sp.kind)](f"{p}_t_{n}").over(w).alias(f"{p}_o_{n}")
                                     for n, sp in specs.items()])
