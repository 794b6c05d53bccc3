"""Column helpers (F1-F13). All are Catalyst expressions: they stay inside
whole-stage codegen and need no Python at execution time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_int(props: str | Column, key: str) -> Column:
    """Integer field of a JSON string column (``events.props``)."""
    return F.get_json_object(col(props), f"$.{key}").cast("int")


def fizzbuzz(n: str | Column) -> Column:
    """Both first, then 3, then 5, else the number as a string."""
    n = col(n)
    return (F.when((n % 3 == 0) & (n % 5 == 0), F.lit("fizzbuzz"))
            .when(n % 3 == 0, F.lit("fizz"))
            .when(n % 5 == 0, F.lit("buzz"))
            .otherwise(n.cast("string")))


def entity_id(*parts: str | Column) -> Column:
    """composed id such as ``player|<id>|<nick>``."""
    return F.concat_ws("|", *[col(p).cast("string") for p in parts])


def epoch_millis(ts: str | Column) -> Column:
    """epoch milliseconds of a TIMESTAMP or TIMESTAMP_NTZ column (NTZ read as UTC)."""
    return F.unix_millis(col(ts).cast("timestamp"))


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def ntz_from_micros(us: Column) -> Column:
    """Inverse of ``epoch_micros`` as TIMESTAMP_NTZ (what the parquet tables hold)."""
    return F.timestamp_micros(us).cast("timestamp_ntz")


def floor_time(ts: str | Column, width_us: int, offset_us: int = 0) -> Column:
    """Epoch-aligned bucket start, like a tumbling window's start, as NTZ."""
    us = epoch_micros(ts) - F.lit(offset_us)
    return ntz_from_micros(F.floor(us / F.lit(width_us)).cast("long") * F.lit(width_us) + F.lit(offset_us))


def pmod_hash(key: str | Column, n: int) -> Column:
    """F8 done right: a non-negative hash of the key's text, modulo n (the reference's ``%`` can go negative).

    The first 32 bits of MD5: any engine gives the same number. A null key hashes as an empty text.
    """
    digits = F.substring(F.md5(F.coalesce(col(key).cast("string"), F.lit(""))), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(n)).cast("int")


def sorted_map_string(m: Column) -> Column:
    """``k=v, k=v`` with keys sorted, for map-typed columns."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")


def interval_us(us: int) -> Column:
    """A day-time interval literal of ``us`` microseconds (for ``ts + interval``)."""
    return F.expr(f"INTERVAL {int(us)} MICROSECONDS")


def duration_us(text: str) -> int:
    """``'3 hours'`` / ``'500 milliseconds'`` -> microseconds (the durations Spark's window takes)."""
    n, unit = text.split()
    unit = unit.lower().rstrip("s")
    scale = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
             "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}[unit]
    return int(float(n) * scale)
